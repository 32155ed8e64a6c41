"""The pipeline against brute force stage by stage, and the registered queries against their SQL."""

import os
import subprocess
import sys

import pytest
import test_decontaminate
import test_mixing_licenses
import test_simhash
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import check_oracles  # noqa: E402
import corpus_pipeline  # noqa: E402

from careflow.llm import queries, toxicity  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def con():
    return check_oracles.connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_its_sql(spark, con, name):
    assert check_oracles.compare(spark, con, SF, name, queries.QUERIES, queries.ORACLES) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_without_sql_runs_on_whole_tables(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = queries.QUERIES[name](spark, SF)
    assert "doc_id" in found.columns
    if name != "op3_decontaminate":
        assert sorted(r[0] for r in found.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())


def test_run_by_hand(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS).collect()]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = [r for r in rows if r[1] and any(map(str.isalpha, r[1]))]
    # The model is what it is; that the stage keeps just what it does not flag is what counts.
    flagged = {r["doc_id"] for r in toxicity.score_toxicity(frame(rows), labels).collect() if r["predicted"]}
    rows = [r for r in rows if r[0] not in flagged]
    group = test_simhash.groups_by_hand({test_simhash.by_hand(r[1]) for r in rows})
    of = {r[0]: frozenset(group[test_simhash.by_hand(r[1])]) for r in rows}
    rows = [r for r in rows if r[0] == min(i for i, g in of.items() if g == of[r[0]])]
    seeds = {}
    for item_id, text in items:
        own = test_decontaminate.words(text)
        for i in range(len(own) - 4):
            seeds.setdefault(tuple(own[i:i + 5]), set()).add(item_id)
    leaks = set()
    for r in rows:
        own = test_decontaminate.words(r[1])
        near = {k for i in range(len(own) - 4) for k in seeds.get(tuple(own[i:i + 5]), ())}
        if test_decontaminate.by_hand([r], [x for x in items if x[0] in near]):
            leaks.add(r[0])
    rows = [r for r in rows if r[0] not in leaks]
    want = {i: round(t[3] / t[0]) for i, t in test_mixing_licenses.mix_by_hand(rows).items() if t[3]}
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == [*COLUMNS, "copies", "target"]
    assert {r["doc_id"]: r["copies"] for r in got.collect()} == want
    assert leaks and len(rows) + len(leaks) < len(of)


ODD = [
    (1, "Some plain words that are here to stay", "en", "a", 1), (1, "Some plain words that are here to stay", "en", "a", 1),
    (2, "some PLAIN words that are here to stay", "en", None, None), (3, None, None, None, None), (4, "", "en", "a", 0),
    (5, "12 34 !", None, "b", 7), (None, "nobody named this text with its own words", None, "b", 1),
    (None, "nobody named this text with its own words", None, "b", 1), (6, "a " * 60_000, "en", "a", 1),
    (1, "the same id again with another text entirely", "en", "a", 1),
]


def test_odd_rows_through_all_stages(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars int")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.columns[:5] == COLUMNS
        left = [(r["doc_id"], (r["text"] or "")[:10]) for r in docs.collect()]
        if name == "language ID":
            assert len(left) == 7 and {i for i, _ in left} == {1, 2, 6, None}
        if name == "SimHash near-dedup":
            assert sorted(left, key=repr) == sorted(
                [(1, "Some plain"), (1, "the same i"), (None, "nobody nam"), (6, "a a a a a ")], key=repr)
    assert (None, "nobody nam") in left


@pytest.mark.parametrize("place", range(5))
def test_stages_on_an_empty_table(spark, place):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    name, stage = corpus_pipeline.STAGES[place]
    assert stage(spark, docs, SF).count() == 0


def test_leaks_go_by_id_and_text(spark):
    """A leaked text goes without an id too; a clean text stays though its id has a leaked one."""
    passage = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    rows = [(None, f"so {passage} it is", "en", "a", 1), (None, "a clean text without a name", "en", "a", 1),
            (1, f"well {passage}", "en", "a", 1), (1, "a clean text of the same id", "en", "a", 1), (2, None, "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    kept = corpus_pipeline.drop_contaminated(spark, docs, SF)
    assert kept.columns == COLUMNS
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([rows[1], rows[3], rows[4]], key=repr)


CLASHES = ("copies target rows kept_id kept_hash leaked_id leaked_key mixed_id mixed_hash _key_id _key_hash _KEY_ID _rows row "
           "root text_hash most unnamed size taken bits phrase score lang_pred held_out predicted fp doc_key _before").split()


@pytest.mark.parametrize("place", range(5))
def test_stages_with_columns_of_any_name(spark, place):
    """Further columns pass through every stage, however they are called."""
    name, stage = corpus_pipeline.STAGES[place]
    plain = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars int")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        more = plain
        for clash in CLASHES:
            more = more.withColumn(clash, F.concat(F.lit(clash), F.col("doc_id")))
        want = sorted((repr(r["doc_id"]), repr(r["text"])) for r in stage(spark, plain, SF).collect())
        found = stage(spark, more, SF)
        rows = found.collect()
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    assert sorted((repr(r["doc_id"]), repr(r["text"])) for r in rows) == want and want
    kept = [c for c in CLASHES if place < 4 or c not in ("copies", "target")]
    assert set(kept) <= set(found.columns)
    for row in rows:
        assert all(row[c] == (None if row["doc_id"] is None else f"{c}{row['doc_id']}") for c in kept)


def test_language_stage_drops_other_languages(spark):
    """Foreign text goes though it has letters; texts in the languages that are wanted stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS)
    foreign = ["これは学んだことのない言語で書かれた文章です。" * 5, "Это предложение написано на языке, которого никто не учил. " * 3]
    rows = [(10 ** 6 + i, t, None, "web", len(t)) for i, t in enumerate(foreign)]
    both = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = corpus_pipeline.identify_language(spark, both, SF)
    assert kept.columns == COLUMNS
    with_letters = both.where(r"text rlike '\\p{L}'").count()
    assert kept.count() == with_letters - 2
    assert kept.where("doc_id >= 1000000").isEmpty()
    french = corpus_pipeline.identify_language(spark, docs, SF, languages=["fr"])
    langs = [r["lang"] for r in french.collect()]
    assert langs.count("fr") >= 0.9 * len(langs) > 0
    # Nothing to learn from: a text with letters stays.
    bare = both.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.identify_language(spark, bare, SF).count() == with_letters


SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
import corpus_pipeline
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
docs = spark.read.parquet({docs!r})
for name, stage in corpus_pipeline.STAGES:
    print(name, "gives", stage(spark, docs, {sf!r}).count())
spark.stop()
"""


def test_workers_of_another_folder_find_the_library(tmp_path):
    """No registered query has run, and the workers know nothing of the library."""
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYTHONPATH", "SPARK_", "PYSPARK_SUBMIT"))}
    code = SCRIPT.format(root=ROOT, docs=f"{SF}/documents.parquet", sf=SF)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.count("gives") == 5, done.stderr[-2000:]
