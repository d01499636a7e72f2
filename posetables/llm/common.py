"""What the operators share: reading documents, batches of texts, the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..storage import shared, shared_folder, written  # noqa: F401

#: Texts are handled in slices of about so many characters, whatever the size of an Arrow batch.
SLICE_CHARS = 1_000_000
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a null text is an empty one. Other columns are left behind."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_CHARS) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, texts) runs of rows of about limit characters; one long text is a run of its own."""
    texts, start, size = [], 0, 0
    for i, text in enumerate(batch.column(column)):
        text = text.as_py()
        texts.append(text)
        size += len(text)
        if size >= limit:
            yield start, i + 1, texts
            texts, start, size = [], i + 1, 0
    if texts:
        yield start, batch.num_rows, texts


def map_texts(docs: DataFrame, columns: Callable[[list[str]], list], schema: str) -> DataFrame:
    """Every row of texts_of(docs) with what columns makes of its text: one array of each added column for a slice of texts.

    schema: the added columns. Rows don't meet, so nothing is shuffled.
    """
    whole = T.StructType([T.StructField("doc_id", T.LongType()), *T.StructType.fromDDL(schema).fields])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(whole)
        for batch in batches:
            for start, end, texts in slices(batch):
                made = columns(texts)
                ids = batch.column("doc_id").slice(start, end - start)
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(x, type=f.type) for x, f in zip(made, list(arrow)[1:], strict=True))], schema=arrow)

    return texts_of(docs).mapInArrow(work, whole)


def sha256_hex(data: bytes) -> str:
    import hashlib

    return hashlib.sha256(data).hexdigest()


def spans_text(spans: list[tuple[str, int, int]], kinds: list[str]) -> str:
    """kind:start:end by start, then kind as listed, comma-joined."""
    rank = {k: i for i, k in enumerate(kinds)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2])))
