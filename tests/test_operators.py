"""Deduplication, imputation, unions, alignment and keyword joins."""

import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from careflow.operators import dedup, filters, hashed, impute, keyword_join, projection, running, union
from careflow.schemas import HEADERS, LIS01, LIS06, target_schema

few = settings(
    max_examples=8, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
records = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 5))),
    max_size=25,
)


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, k, v) for i, (k, v) in enumerate(rows)], "id int, k int, v int")


def expected_first(rows):
    """Greatest v (null last), then smallest id, per k; nulls are one key."""
    best = {}
    for i, (k, v) in enumerate(rows):
        rank = (v is None, -(v or 0), i)
        if k not in best or rank < best[k][0]:
            best[k] = (rank, i)
    return sorted(i for _, i in best.values())


@few
@given(records)
def test_keep_first(spark, rows):
    df = frame(spark, rows)
    order = [F.desc_nulls_last("v"), F.asc("id")]
    once = dedup.keep_first(df, ["k"], order)
    assert sorted(r.id for r in once.collect()) == expected_first(rows)
    # Idempotent, blind to partitioning, and every row is either kept or removed.
    assert sorted(r.id for r in dedup.keep_first(once, ["k"], order).collect()) == expected_first(rows)
    spread = dedup.keep_first(df.repartition(3), ["k"], order)
    assert sorted(r.id for r in spread.collect()) == expected_first(rows)
    removed = dedup.removed_rows(df, ["k"]).first()[0]
    assert removed + once.count() == len(rows)


@few
@given(records, st.sampled_from([1, 3, 20_000]))
def test_with_group_size(spark, rows, hot_share):
    sized = dedup.with_group_size(frame(spark, rows), ["k"], ["id"], hot_share).collect()
    keys = [k for k, _ in rows]
    assert sorted((r.id, r.group_size) for r in sized) == [
        (i, keys.count(k)) for i, k in enumerate(keys)]


def test_duplicates_audit(spark):
    df = frame(spark, [(1, 1), (1, 2), (2, 3), (None, 4), (None, 5)])
    assert {(r.k, r.group_size) for r in dedup.duplicate_groups(df, ["k"]).collect()} == {(1, 2)}
    assert sorted(r.id for r in dedup.duplicate_members(df, ["k"], ["id"]).collect()) == [0, 1]
    both = dedup.duplicate_groups(df, ["k"], keep_null_keys=True)
    assert {(r.k, r.group_size) for r in both.collect()} == {(1, 2), (None, 2)}
    assert {r.k for r in dedup.distinct_keys(df, "k").collect()} == {1, 2}


def test_keep_first_plan_limits_groups_before_the_shuffle(spark):
    df = frame(spark, [(1, 1), (1, 2)])
    plan = dedup.keep_first(df, ["k"], [F.asc("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_drop_duplicate_rows(table):
    df = table(["a", "b"], [("x", None), ("x", None), ("x", "y")])
    assert dedup.drop_duplicate_rows(df).count() == 2


def test_latest_sorted(spark):
    df = frame(spark, [(1, None), (1, 5), (2, 9), (2, 5)])
    assert [r.id for r in dedup.latest_sorted(df, "v", ["id"]).collect()] == [2, 1, 3, 0]
    assert [r.id for r in dedup.latest_sorted(df, "v", ["id"], 2).collect()] == [2, 1]


@few
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3), st.floats(-1e6, 1e6)), max_size=40))
def test_exact_medians(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    known = [float(v) for v in values if v is not None]
    want = statistics.median(known) if known else None
    for options in ({}, {"counts": {"x": len(known)}}):
        got = impute.exact_medians(df, ["x"], **options)["x"]
        assert got == pytest.approx(want) if known else got is None


def test_exact_medians_of_several_columns(spark):
    rows = [(float(i % 5), None, float(-i), 1.0 if i == 3 else None) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    assert impute.exact_medians(df, list("abcd")) == {"a": 2.0, "b": None, "c": -9.5, "d": 1.0}


@pytest.mark.parametrize("width", [31, 32, 33, 63, 64, 65, 100])
def test_mode_of_any_number_of_columns(spark, width):
    rows = [[None if (r + c) % 4 == 0 else (r * (c + 1)) % 3 for c in range(width)] for r in range(8)]
    df = spark.createDataFrame(rows, ", ".join(f"c{c} int" for c in range(width)))
    got = impute.fill_missing(df, "mode").collect()
    for c in range(width):
        known = [r[c] for r in rows if r[c] is not None]
        mode = min(known, key=lambda v: (-known.count(v), v))
        assert [g[c] for g in got] == [mode if r[c] is None else r[c] for r in rows]


def test_running_totals(spark):
    df = spark.createDataFrame([(k, n) for k, n in zip("qwertyuiopasdfgh", range(16))], "k string, n int")
    got = {r["k"]: r["_before"] for r in running.with_total_before(df.repartition(5), ["k"], F.col("n")).collect()}
    total, rows = 0, sorted(zip("qwertyuiopasdfgh", range(16)))
    for k, n in rows:
        assert got[k] == total
        total += n


@pytest.fixture(scope="module")
def gaps(spark):
    return spark.createDataFrame(
        [(None, "a", 1.0, None), (2, "b", None, None), (2, None, 3.0, None),
         (1, "b", float("nan"), None), (1, "a", 3.0, None)],
        "i int, s string, d double, z string")


@pytest.mark.parametrize("strategy, i, s, d", [
    ("default", [0, 2, 2, 1, 1], ["a", "b", "", "b", "a"], [1, 0, 3, 0, 3]),
    ("mean", [1.5, 2, 2, 1, 1], ["a", "b", "", "b", "a"], [1, 7 / 3, 3, 7 / 3, 3]),
    ("median", [1.5, 2, 2, 1, 1], ["a", "b", "", "b", "a"], [1, 3, 3, 3, 3]),
    # Ties take the smallest value; a column without any value becomes blank.
    ("mode", [1, 2, 2, 1, 1], ["a", "b", "a", "b", "a"], [1, 3, 3, 3, 3]),
])
def test_fill_missing(gaps, strategy, i, s, d):
    rows = impute.fill_missing(gaps, strategy).collect()
    assert [r.i for r in rows] == i
    assert [r.s for r in rows] == s
    assert [r.d for r in rows] == pytest.approx(d)
    assert [r.z for r in rows] == [""] * 5


def test_fill_missing_rejects_unknown(gaps):
    with pytest.raises(ValueError):
        impute.fill_missing(gaps, "magic")


def test_outer_union_settles_types(spark, table):
    numbers = spark.createDataFrame([(30, 1.0)], "code int, x double")
    texts = table(["code", "y"], [("030", "b")])
    united = union.outer_union([numbers, texts])
    assert united.columns == ["code", "x", "y"]
    assert {tuple(r) for r in united.collect()} == {("30", 1.0, None), ("030", None, "b")}
    assert dict(union.outer_union([numbers, texts], as_strings=True).dtypes)["x"] == "string"


def test_align(spark):
    df = spark.createDataFrame([(7.0, 2.5, "x")], "` 患者ID ` double, `年龄` double, other string")
    loose = df.select(*projection.align(df, ["患者ID", "年龄", "就诊日期", "备注"], clean=True))
    assert loose.first() == ("7", "2.5", "", None)
    strict = df.select(*projection.align(df, ["患者ID", "年龄"]))
    assert strict.first() == (None, "2.5")


def test_rules_first_match_then_same_name_then_null(table):
    df = table(["id", "b"], [("7", "own")])
    rules = [projection.Rule(("患者",), None), projection.Rule(("患者", "x"), F.col("id")),
             projection.Rule(("x",), F.lit("late"))]
    got = df.select(*projection.map_columns(df, ["患者ID", "X", "b", "c"], rules))
    assert got.first() == ("7", "7", "own", None)


def test_headers_and_prefix(spark, table):
    assert [len(h) for h in HEADERS.values()] == [28, 14, 14, 13, 11, 12, 17]
    wide = table(list(HEADERS[LIS01]), [tuple("x" * 28)])
    assert projection.prefix_columns(wide, 14).columns == list(HEADERS[LIS01][:14])
    assert projection.existing_header(None, HEADERS[LIS06]) == list(HEADERS[LIS06])
    assert projection.existing_header(table(["a", "_row_idx"], []), HEADERS[LIS06]) == ["a"]
    empty = filters.empty_table(wide, target_schema(LIS06))
    assert empty.columns == list(HEADERS[LIS06]) and empty.count() == 0


def test_keyword_rows(table):
    df = table(["t"], [("pcr",), ("PCR",), (None,)])
    assert [r.t for r in filters.keyword_rows(df, "t", ["PCR"]).collect()] == ["PCR"]
    assert filters.keyed_rows(df, "t").count() == 2


# One plan for a few terms, another for more; the bound between them, from both sides.
TIERS = [{}, {"max_nested_terms": 0}, {"max_nested_terms": 6}, {"max_nested_terms": 7}]


@pytest.mark.parametrize("options", TIERS)
def test_keyword_semijoin_against_brute_force(spark, options):
    texts = ["abcdef", "xyz", "", None, "新冠核酸检测", "q" * 700 + "needle in the hay" + "q" * 90,
             "a" * 255 + "bc", "ab" * 400]
    terms = ["bc", "核酸", None, "bc", "needle in the ha", "nope", "q" * 33, "ba" * 20]
    # A row whose key is null in part or in whole is a row like any other.
    keys = [(i if i % 3 else None, "x" if i % 2 else None) for i in range(len(texts))]
    rows = [(i, *k, t) for i, (k, t) in enumerate(zip(keys, texts))]
    docs = spark.createDataFrame(rows, "id int, k int, l string, t string").filter("id <> 6")
    vocabulary = spark.createDataFrame([(w,) for w in terms], "w string")
    found = keyword_join.keyword_semijoin(docs, "t", vocabulary, "w", ["k", "l"], **options)
    want = [i for i, t in enumerate(texts) if i != 6 and t is not None and any(w in t for w in terms if w)]
    assert sorted(r.id for r in found.collect()) == want and 0 in want
    none = keyword_join.keyword_semijoin(docs, "t", vocabulary.limit(0), "w", ["id"], **options)
    assert none.count() == 0


@few
@given(st.lists(st.text("ab新", max_size=12), max_size=8),
       st.lists(st.text("ab新", min_size=1, max_size=5), min_size=1, max_size=5))
def test_keyword_semijoin_by_anchors_property(spark, texts, terms):
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    vocabulary = spark.createDataFrame([(w,) for w in terms], "w string")
    found = keyword_join.keyword_semijoin(docs, "t", vocabulary, "w", ["id"], 0)
    assert sorted(r.id for r in found.collect()) == [
        i for i, t in enumerate(texts) if any(w in t for w in terms)]


def test_terms_across_blocks_and_longer_than_them(spark, monkeypatch):
    text = "".join(chr(97 + i * i % 23) for i in range(5000)).encode()
    known = np.ones(1 << 16, bool)
    monkeypatch.setattr(keyword_join, "BLOCK", 64)
    pieces = keyword_join._pieces(text, {1: (0, 1), 2: (1, 2), 32: (100, 200)}, known)
    assert {p for _, _, p in pieces if len(p) == 300} == {text[i:i + 300] for i in range(len(text) - 299)}
    assert {(at, p) for _, at, p in pieces if len(p) <= 3} >= {(1, text[i:i + 3]) for i in range(len(text) - 2)}


def test_anchors_send_few_rows(spark):
    """Texts without terms send nothing; what is sent doesn't grow with repeats in a text."""
    anchors = spark.createDataFrame(
        [(int(hashed.window_hashes(b"need", (4,))[4].view(np.int64)[0]),)], "h long")
    known = hashed.unpacked(hashed.bit_filter(anchors, "h", 16))
    assert known.sum() <= len(hashed.PROBES)
    assert 1 <= len(keyword_join._pieces(b"need " * 5000, {4: (1, 5)}, known)) <= 3
    assert len(keyword_join._pieces(b"hay and straw " * 5000, {4: (1, 5)}, known)) == 0


@pytest.mark.parametrize("n", [10, 300_000])
def test_filter_lets_few_others_pass(spark, n):
    hashes = spark.range(n).select(F.xxhash64("id").alias("h"))
    bits = hashed.filter_bits(n)
    known = hashed.unpacked(hashed.bit_filter(hashes, "h", bits))
    inside = np.array([r.h for r in hashes.collect()], np.int64).view(np.uint64)
    others = np.random.default_rng(5).integers(0, 1 << 64, 100_000, np.uint64)
    assert len(known) == 1 << bits and len(hashed.passes(inside, known)) == n
    assert len(hashed.passes(others, known)) < 300
    assert hashed.filter_bits(10 ** 12) == hashed.MOST_BITS


def test_terms_with_a_common_beginning_have_anchors_of_their_own(spark):
    """100,000 addresses that share 32 bytes and more; no window stands for many of them."""
    terms = spark.range(100_000).select(
        F.concat(F.lit("https://www.example.com/articles/of/"), F.hash("id").cast("string"), F.lit(".html"))
        .alias("_term"))
    counts = keyword_join._sketch(terms.select(F.col("_term").cast("binary")), (32,))
    anchored = keyword_join._anchored_terms(terms, spark.sparkContext.broadcast(counts))
    assert anchored.groupBy("_anchor").count().agg(F.max("count")).first()[0] <= 20
    texts = terms.withColumnRenamed("_term", "t").limit(3000).select(
        F.monotonically_increasing_id().alias("id"), F.concat(F.lit("see "), "t", F.lit(" or https://www.example.com/articles/of/none.html")).alias("t"))
    odd = texts.withColumn("t", F.when(F.col("id") % 2 == 1, F.regexp_replace("t", "html", "htm")).otherwise(F.col("t")))
    found = keyword_join.keyword_semijoin(odd, "t", terms, "_term", ["id"])
    assert found.count() == odd.filter("id % 2 = 0").count()


def test_large_vocabularies_are_looked_up_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(keyword_join, "MOST_HASHES", 3)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta"]
    texts = [f"the {w} of it" for w in words] + ["alph", "", "zet eth"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    vocabulary = spark.createDataFrame([(w,) for w in words], "w string")
    found = keyword_join.keyword_semijoin(docs, "t", vocabulary, "w", ["id"], 0)
    assert sorted(r.id for r in found.collect()) == list(range(len(words)))


def test_equal_rows_of_a_hot_key_are_spread(spark):
    """A million equal rows, without a row key: over many partitions, each with the size of its group."""
    df = spark.range(1_000_000, numPartitions=4).select(F.lit("k").alias("k"), F.lit(1).alias("v"))
    found = dedup.duplicate_members(df, ["k"])
    # Without a broadcast, so that the rows have to move.
    forced = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "64",
              "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in forced}
    for name, value in forced.items():
        spark.conf.set(name, value)
    try:
        parts = found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.min("group_size"), F.max("group_size")).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(parts) >= 50 and sum(p["n"] for p in parts) == 1_000_000
    assert {(p[2], p[3]) for p in parts} == {(1_000_000, 1_000_000)} and max(p["n"] for p in parts) < 60_000


def test_approximate_median_keeps_its_promise(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 5 > 0, (F.col("id") * 7919) % 20_011).cast("double").alias("x"), F.lit(None).cast("int").alias("none"),
        F.when(F.col("id") % 2 == 0, "t").alias("t"))
    known = sorted(r.x for r in df.where("x is not null").collect())
    for accuracy in (50, 1000):
        row = impute.approximate_medians(df, ["x", "none"], accuracy).first()
        assert row["none"] is None
        assert abs(known.index(row["x"]) - len(known) / 2) <= len(known) / accuracy + 1
    filled = impute.fill_missing(df, "median_approx", 1000)
    assert filled.where("x is null or t is null").isEmpty() and filled.where("none is not null").isEmpty()
