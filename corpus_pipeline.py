"""A corpus pipeline of text operators: each stage works on all that the one before it kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the documents it
keeps.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.llm import decontaminate, language, mixing, simhash, toxicity
from careflow.llm.common import cut, table


#: A text is in a language if the phrases it shares with that language's labelled text average so many
#: bytes: 1 means that not even two letters in a row occur there.  Texts of the learned languages have 4.5 or
#: more in 99 of 100 cases; Japanese or Russian among four European languages has 1.0.
LEAST_PHRASE = 2.0


def _apart(name: str, docs: DataFrame) -> str:
    """The name, or one like it that no column of ``docs`` has (Spark does not tell cases apart)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _keys(rows: DataFrame, docs: DataFrame, doc_id: str, text_hash: str) -> tuple[DataFrame, Column]:
    """``rows`` with its key under names that ``docs`` lacks, and the condition that a document has that key."""
    own_id, own_hash = _apart("_key_id", docs), _apart("_key_hash", docs)
    named = rows.withColumnsRenamed({doc_id: own_id, text_hash: own_hash})
    return named, F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.xxhash64("text") == F.col(own_hash))


def identify_language(
    spark: SparkSession, docs: DataFrame, sf_dir: str, languages: Collection[str] | None = None,
    least_phrase: float = LEAST_PHRASE,
) -> DataFrame:
    """Documents in one of ``languages``, by default in any that ``docs`` labels.

    A text that is null, empty or without a letter goes, and so does one that shares only phrases of fewer
    than ``least_phrase`` bytes with the language that is nearest to it: it is in none of them.  A language
    of which hardly anything is labelled (2 KB) can't tell that, its texts stay.  If nothing could be learned,
    no language is told; texts with letters stay then.  Long texts are judged as a whole;
    repeated rows and further columns, whatever their names, stay as they are; an empty table stays empty.
    """
    told = language.identify(docs, carry=True)
    letters = F.coalesce(F.col("row")["text"].rlike(r"\p{L}"), F.lit(False))
    wanted = F.coalesce(F.col("phrase") >= least_phrase, F.lit(True))
    if languages is not None:
        wanted = wanted & F.col("lang_pred").isin(*languages)
    # Only where nothing was learned does a text with letters have no language.
    unknown = F.lit(languages is None) & letters
    return told.where(F.when(F.col("lang_pred") == language.UNKNOWN, unknown).otherwise(wanted)).select("row.*")


def filter_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic.

    Null and empty texts have a score as well, that of no window, and stay if it is low.  Long texts are
    scored window by window as a whole; equal texts have equal scores, so repeated rows stay or go together;
    further columns, whatever their names, stay; an empty table stays empty.
    """
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"), carry=True)
    return scored.where(F.col("predicted") == 0).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id, rows without an id last.

    Of rows that repeat an id, the text with the smallest hash; of equal rows, one.  Null, empty and
    wordless texts are one group; long texts are hashed as a whole; further columns, whatever their names,
    stay; an empty table stays empty.
    """
    found = simhash.near_duplicates(docs, width=4, distance=4)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("first")
    rows = found.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    chosen = cut(
        rows.groupBy("root").agg(first, F.max("copies").alias("most")).select("first.doc_id", "first.text_hash", "most"))
    single, same = _keys(chosen.where(F.col("most") == 1).drop("most"), docs, "doc_id", "text_hash")
    kept = docs.join(single, same, "left_semi")
    several = chosen.where(F.col("most") > 1).drop("most")
    if several.isEmpty():
        return kept
    repeated, same = _keys(several, docs, "doc_id", "text_hash")
    return kept.unionByName(docs.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark, each by its own text, with or without an id.

    Null and empty texts hold none; long texts are searched as a whole; repeated rows stay or go together;
    further columns, whatever their names, stay; an empty table, or benchmark, drops nothing.
    """
    found = decontaminate.contaminated_texts(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "doc_key")
    leaked, same = _keys(found, docs, "doc_id", "doc_key")
    return docs.join(leaked, same, "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``copies`` of each and its source's ``target`` in words.

    Equal rows (id and text) are one document here; texts that are null, empty or without words add nothing
    to a mix by words and go.  A long text is taken as a whole.  Input columns named ``copies`` or ``target``
    give way to the result's; other columns, whatever their names, stay; an empty table stays empty.
    """
    rows = _apart("_rows", docs)
    taken = (
        mixing.mix_sources(docs).where(F.col("taken") > 0).groupBy("doc_id", "text_hash")
        .agg(F.sum(F.col("taken") / F.col("size")).cast("int").alias("copies"), F.max("target").alias("target"),
             F.count(F.lit(1)).alias(rows))
    )
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("copies", "target")]
    taken, same = _keys(cut(taken), docs, "doc_id", "text_hash")
    mixed = docs.select(*kept).join(taken, same)
    result = mixed.where(F.col(rows) == 1).select(*kept, "copies", "target")
    if taken.where(F.col(rows) > 1).isEmpty():
        return result
    repeated = mixed.where(F.col(rows) > 1).dropDuplicates(["doc_id", "text"])
    return result.unionByName(repeated.select(*kept, "copies", "target"))


STAGES = [
    ("language ID", identify_language),
    ("toxicity", filter_toxic),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
]
#: Training models and tiling texts are beyond SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written once before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
