"""Vector expressions on array columns, and text embedding."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from hashlib import md5
from string import ascii_lowercase, digits

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.feature import HashingTF, Normalizer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import EMBEDDING_DIM
from ..runtime import ship_package


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def normalize(v: Column) -> Column:
    """Unit vector; a zero vector stays zero."""
    norm = l2_norm(v)
    return F.transform(v, lambda x: F.when(norm > 0, x / norm).otherwise(0.0))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity, 0 when either vector is zero."""
    return F.coalesce(F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b)), F.lit(0.0))


Embedder = Callable[[DataFrame, str, str], DataFrame]


def hashed_embedder(dim: int = EMBEDDING_DIM) -> Embedder:
    """Hashed word counts scaled to unit length, computed in the JVM."""

    def embed(df: DataFrame, text: str, vector: str) -> DataFrame:
        stages = PipelineModel(
            [
                Tokenizer(inputCol=text, outputCol="_words"),
                HashingTF(numFeatures=dim, inputCol="_words", outputCol="_counts"),
                Normalizer(p=2.0, inputCol="_counts", outputCol="_unit"),
            ]
        )
        return (
            stages.transform(df)
            .withColumn(vector, vector_to_array("_unit", "float32"))
            .drop("_words", "_counts", "_unit")
        )

    return embed


#: Words whose place a worker remembers; it then forgets all and starts anew.
REMEMBERED_WORDS = 200_000
#: Texts whose words are counted at once.
TEXTS_PER_STEP = 2_000
#: UTF-8 bytes: A-Z become a-z, all that is no letter a-z or digit becomes a blank.
WORD_BYTES = bytes(ord(c) if (c := chr(b).lower()) in ascii_lowercase + digits else ord(" ") for b in range(256))


def digest_place(word: str, dim: int) -> tuple[int, int]:
    """Place and sign of a word, both read off its MD5 text."""
    digest = md5(word.encode()).hexdigest()
    return int(digest[:8], 16) % dim, 1 if int(digest[8], 16) % 2 == 0 else -1


class KnownPlaces(dict):
    """Places of words, those of negative sign ``dim`` further on; no word is after both."""

    def __init__(self, dim: int):
        super().__init__()
        self.dim = dim

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        place, sign = digest_place(word, self.dim) if word else (2 * self.dim, 1)
        self[word] = place if sign > 0 else place + self.dim
        return self[word]


def counted_places(texts: pd.Series, known: KnownPlaces) -> np.ndarray:
    """Signed word counts of each text, as whole numbers."""
    plain = pa.array([(text or "").encode().translate(WORD_BYTES).decode() for text in texts], pa.large_string())
    words = pc.ascii_split_whitespace(plain)
    met = words.flatten().dictionary_encode()
    places = np.fromiter(map(known.__getitem__, met.dictionary.to_numpy(zero_copy_only=False)), "int64", len(met.dictionary))
    width = 2 * known.dim + 1
    row = np.repeat(np.arange(len(texts)), np.diff(words.offsets.to_numpy()))
    at = row * width + places[met.indices.to_numpy()]
    counts = np.bincount(at, minlength=len(texts) * width).reshape(-1, width)
    return counts[:, : known.dim] - counts[:, known.dim : 2 * known.dim]


def _scaled(counts: np.ndarray) -> np.ndarray:
    norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
    return (counts / np.where(norms > 0, norms, 1.0)).astype("float32")


def digest_embedder(dim: int = EMBEDDING_DIM) -> Embedder:
    """Signed word counts scaled to unit length. Words are the runs of letters a-z and
    digits of the lower-cased text (only A-Z are lower-cased); place and sign come from
    their MD5, so any engine can repeat the vectors. A text without words, or whose
    words cancel out, has the zero vector; null counts as empty.
    """

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = KnownPlaces(dim)
        for texts in batches:
            parts = [
                counted_places(texts.iloc[at : at + TEXTS_PER_STEP], known) for at in range(0, len(texts), TEXTS_PER_STEP)
            ]
            yield pd.Series([row for part in parts for row in _scaled(part)], index=texts.index)

    def embed(df: DataFrame, text: str, vector: str) -> DataFrame:
        ship_package(df.sparkSession)
        return df.withColumn(vector, encode(text))

    return embed


_models: dict[str, Callable[[list[str]], np.ndarray]] = {}


def kept_model(name: str, load: Callable) -> Callable[[list[str]], np.ndarray]:
    """The model of this worker process, loaded when it is first asked for."""
    if name not in _models:
        _models[name] = load()
    return _models[name]


def model_embedder(
    load: Callable[[], Callable[[list[str]], np.ndarray]], batch_size: int = 32
) -> Embedder:
    """Any text model: ``load`` runs once in each worker process, which keeps the
    model for its later tasks. Vectors are scaled to unit length.
    """
    name = uuid.uuid4().hex

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = kept_model(name, load)
        for texts in batches:
            parts = [
                np.asarray(model(texts.iloc[i : i + batch_size].tolist()), dtype="float64")
                for i in range(0, len(texts), batch_size)
            ]
            vectors = np.concatenate(parts) if parts else np.zeros((0, 1))
            norms = np.linalg.norm(vectors, axis=1, keepdims=True)
            unit = vectors / np.where(norms > 0, norms, 1.0)
            yield pd.Series(list(unit.astype("float32")), index=texts.index)

    def embed(df: DataFrame, text: str, vector: str) -> DataFrame:
        ship_package(df.sparkSession)
        return df.withColumn(vector, encode(text))

    return embed
