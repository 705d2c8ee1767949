"""Token counts of whole texts; huge texts are encoded in overlapping chunks.

Chunks overlap, and each is encoded with the offsets of its pieces. Two
neighbouring encodings are spliced at a place where both have a piece boundary
that is proven stable: the boundary stands before a space that follows a
character which is no space, and no piece of the vocabulary has a space after
such a character. A merge across that place would have to make such a piece, so
the pieces on either side of it don't depend on what lies beyond. If an overlap
has no such place it is widened, up to the whole text if need be.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_tasks

#: Bytes of a chunk; texts with fewer characters are encoded in one go.
CHUNK = 1 << 16
#: Bytes that neighbouring chunks share at first.
OVERLAP = 256
LIMIT = 4096
MARK = "▁"  # how pieces write a space


@cache
def load_processor(path: str):
    """One processor for each worker process, and whether its pieces can prove
    boundaries before spaces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i).replace(" ", MARK) for i in range(model.get_piece_size()))
    provable = not any(MARK in p.lstrip(MARK) for p in pieces) and keeps_text(model)
    return model, provable


def keeps_text(model) -> bool:
    """Whether the model encodes characters as they are: normalisation that
    rewrites or drops characters would make offsets in texts unsafe."""
    return model.normalize("a  b ａ ½\n\tc ").lstrip(MARK).replace(MARK, " ") == "a  b ａ ½\n\tc "


def boundaries(model, raw: bytes, start: int) -> dict[int, int]:
    """Byte of the whole text at every piece's begin -> pieces before it.

    ``raw`` was cut at ``start``. Several pieces of one character share its
    begin, of which the first counts.
    """
    found: dict[int, int] = {}
    for n, piece in enumerate(model.encode(raw, return_type="proto").pieces):
        found.setdefault(start + piece.begin, n)
    return found


def stable(raw: bytes, at: int) -> bool:
    before = raw[max(0, at - 3) : at]
    return 0 < at < len(raw) and raw[at] == 32 and before[-1:] != b" " and before != MARK.encode()


def whole_character(raw: bytes, at: int) -> int:
    """The begin of the character that holds this byte."""
    while 0 < at < len(raw) and raw[at] & 0xC0 == 0x80:
        at -= 1
    return at


def cut_from(raw: bytes, start: int, end: int) -> tuple[bytes, int]:
    """The text between two places as the model must see it, and its offset: at
    the start of a chunk the model puts a space, which stands for the one there."""
    skip = 1 if start and raw[start] == 32 else 0
    return raw[start + skip : end], start + skip


def splice_count(model, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Pieces of the whole text, of which only about a chunk is encoded at a time."""
    raw = text.encode()
    total, start = 0, 0
    size, width = chunk, overlap
    while start + size < len(raw):
        end = whole_character(raw, start + size)
        other = whole_character(raw, max(start, end - width))
        if other == start:  # the overlap has grown to the whole chunk
            size *= 2
            continue
        mine = boundaries(model, *cut_from(raw, start, end))
        beyond = whole_character(raw, min(len(raw), end + width))
        theirs = boundaries(model, *cut_from(raw, other, beyond))
        common = [at for at in theirs if other < at < end and at in mine and stable(raw, at)]
        if not common:
            width *= 2
            continue
        place = common[len(common) // 2]
        total += mine[place]
        start, size, width = place, chunk, overlap
    return total + len(model.encode(cut_from(raw, start, len(raw))[0]))


def count_pieces(path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, provable = load_processor(path)
        for batch in batches:
            counts = []
            for at in range(0, batch.num_rows, 256):
                texts = [t or "" for t in batch["text"].slice(at, 256).to_pylist()]
                huge = [provable and len(t) > chunk for t in texts]
                whole = iter(model.encode([t for t, h in zip(texts, huge) if not h], num_threads=1))
                for text, spliced in zip(texts, huge):
                    counts.append(splice_count(model, text, chunk, overlap) if spliced else len(next(whole)))
            rest = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in rest), pa.array(counts, pa.int64())], [*rest, "n_tokens"]
            )

    return run


def count_tokens(
    docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row.

    ``path`` is a sentencepiece model that every worker can read. Null and empty
    texts have no bytes and no tokens. Special strings in texts are plain text.
    Rows are counted one by one where they are read: repeated rows stay, nothing
    is shuffled, other columns are ignored.
    """
    rows = docs.select(
        "doc_id",
        F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("n_bytes"),
        F.col("text").cast("string").alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = in_tasks(rows, count_pieces(path, chunk, overlap), f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
