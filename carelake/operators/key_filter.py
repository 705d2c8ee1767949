"""A Bloom filter over the keys of a table, to leave rows out before they are shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import ship_package

#: About one key in 300 that is not in the filter passes it.
BITS_PER_KEY, HASHES = 12, 5
#: The largest filter, 64 MB; it goes through the driver to every executor.
MAX_BITS = 1 << 29
CHUNK_BYTES = 1 << 16


def _places(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Bits of each 64-bit hash: steps of its upper half from its lower half."""
    unsigned = hashes.view(np.uint64)
    step = (unsigned >> np.uint64(32)) | np.uint64(1)
    for i in range(HASHES):
        yield ((unsigned + np.uint64(i) * step) & np.uint64(bits - 1)).astype(np.int64)


class KeyFilter:
    """Built from distinct keys by partial filters of the tasks, merged by chunk."""

    def __init__(self, keys: DataFrame, key: str, n: int):
        spark = keys.sparkSession
        ship_package(spark)
        self.bits = bits = max(CHUNK_BYTES * 8, 1 << (n * BITS_PER_KEY - 1).bit_length())

        def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros(bits, dtype=bool)
            for batch in batches:
                for places in _places(batch["h"].to_numpy(), bits):
                    held[places] = True
            packed = np.packbits(held, bitorder="little").reshape(-1, CHUNK_BYTES)
            for chunk in np.flatnonzero(packed.any(axis=1)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int32()), pa.array([packed[chunk].tobytes()], pa.binary())], ["chunk", "part"]
                )

        def merged(group: pa.Table) -> pa.Table:
            whole = np.zeros(CHUNK_BYTES, dtype=np.uint8)
            for part in group["part"].to_pylist():
                whole |= np.frombuffer(part, dtype=np.uint8)
            return pa.table({"chunk": group["chunk"][:1], "part": pa.array([whole.tobytes()], pa.binary())})

        schema = "chunk int, part binary"
        hashed = keys.select(F.xxhash64(key).alias("h"))
        chunks = hashed.mapInArrow(marked, schema).groupBy("chunk").applyInArrow(merged, schema).collect()
        found = np.zeros(bits // 8, dtype=np.uint8)  # MAX_BITS at most
        for r in chunks:
            found[r.chunk * CHUNK_BYTES : (r.chunk + 1) * CHUNK_BYTES] = np.frombuffer(r.part, dtype=np.uint8)
        self._found = spark.sparkContext.broadcast(found)

    @classmethod
    def of(cls, keys: DataFrame, key: str, max_bits: int = MAX_BITS) -> KeyFilter | None:
        """None if the keys are so many that a filter of ``max_bits`` would pass most rows."""
        n = keys.count()
        return cls(keys, key, max(n, 1)) if n * BITS_PER_KEY <= max_bits else None

    def keep(self, rows: DataFrame, key: str) -> DataFrame:
        """``rows`` but for most of those whose key the filter has not seen."""
        found, bits = self._found, self.bits

        @F.pandas_udf("boolean")
        def may_be_in(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for hashes in batches:
                inside = np.ones(len(hashes), dtype=bool)
                for places in _places(hashes.to_numpy(dtype="int64"), bits):
                    inside &= (found.value[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1
                yield pd.Series(inside, index=hashes.index)

        return rows.where(may_be_in(F.xxhash64(key)))
