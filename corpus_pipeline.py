"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents its predecessor kept, and its decisions take effect: rejected
documents and repeated lines are gone for the next. All but the last return the columns of
``documents``. Between stages ``run`` writes Parquet into the shared folder and reads it back,
so a lost executor costs one stage's tasks at most. A stage's scratch goes when its result is
written, and that result when the next one's is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthwatt.llm.frames import delete, find_package, new_path, stored, stored_result
from hearthwatt.llm.linededup import dedup_lines
from hearthwatt.llm.packing import pack_documents
from hearthwatt.llm.quality import score_quality
from hearthwatt.llm.queries import PACKING_RANKS, PACKING_TOKENIZER, table
from hearthwatt.llm.simhash import simhash_components
from hearthwatt.llm.toxicity import score_toxicity, train_toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half, scored where they lie. A text that is
    null, empty or of any length is scored whole; repeated rows are scored alike. A model that knows no toxic token rejects nothing."""
    docs = docs.select(COLUMNS)
    model = train_toxicity(docs, table(spark, sf_dir, "labels"))
    if not model.scores:
        return docs
    return score_toxicity(docs, model, keep=tuple(COLUMNS)).where("predicted = 0").select(COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are good more likely than not, given their text and their site; a source
    stands for the host, a language for the path on it. Null and empty texts are judged by the
    same measures as others, repeated rows alike, rows without source or language as sites of
    their own."""
    # Rows that agree in this key agree in everything that is judged; texts move once.
    keys = {f"key_{k}": F.xxhash64(F.lit(k), *[F.col(c) for c in COLUMNS]) for k in (0, 1)}
    keyed = docs.select(COLUMNS).withColumns(keys)
    labels = table(spark, sf_dir, "labels")
    scored = score_quality(keyed, labels, lambda: F.col("source"), lambda: F.col("lang"), keep=tuple(keys))
    kept = stored(scored.where("keep = 1").select(*keys).distinct(), "kept")
    return keyed.join(kept, list(keys), "left_semi").select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of three lines or more that occur before. One of which
    nothing is left stays as an empty one, of which the next stage keeps one. Null texts stay
    null; ``n_chars`` is that of the new text."""
    found = dedup_lines(docs.select(COLUMNS))
    return found.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group whose SimHash fingerprints (shingles of
    three words) are linked by two differing bits or fewer. Of rows of one id the one of the
    smallest text hash stays, of rows that repeat one; documents without id stay only in groups
    that have no other. Null, empty and wordless texts are one group."""
    key = {"none": F.col("doc_id").isNull(), "id": F.coalesce("doc_id", F.lit(0)), "copy": F.xxhash64(F.coalesce("text", F.lit("")))}
    keyed = docs.select(COLUMNS).withColumns(key)
    found = simhash_components(keyed, size=3, keep=tuple(key))
    firsts = found.groupBy("component_id").agg(F.min(F.struct(*key)).alias("first"))
    firsts = stored(firsts.select("first.*"), "firsts")
    return keyed.join(firsts, list(key), "left_semi").dropDuplicates(list(key)).select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens. A null or empty text is one
    token, a repeated row a document of its own; long texts are cut, none is left out."""
    return pack_documents(docs, PACKING_TOKENIZER, PACKING_RANKS, capacity=2048)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("simhash", near_dedup),
    ("packing", packing),
]

#: Learned models and fingerprints have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    find_package(spark)
    docs = table(spark, sf_dir, "documents").select(COLUMNS)
    last = None
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        docs = stored_result(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), path)
        if last:
            delete(spark, last)
        last = path
    return docs
