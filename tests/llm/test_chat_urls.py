"""Chat formatting and URL filter: round trips, rules by brute force, odd input."""

import hashlib
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from careflow.llm import chat, url_filter

CONTROL = ["### Assistant: </turn> ok", "\\### </turn>\n<part>", "\\", "\\l\\h\\b\\c", "a: b", "", "é\n\n#", ": "]


def read_back(turns):
    formatted = chat.format_chats(turns)
    return {
        r["conv_id"]: r for r in formatted.select(
            "*", chat.read_turns(F.col("formatted")).alias("turns"),
            chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}


def test_round_trip_of_control_strings(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(CONTROL)]
    rows += [(2, i, "assistant" if i < 5 else "a:#<\\", t) for i, t in enumerate(CONTROL)]
    found = read_back(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    for conv in (1, 2):
        own = [r for r in rows if r[0] == conv]
        assert [(t["role"], t["text"]) for t in found[conv]["turns"]] == [(r[2], r[3]) for r in own]
        assert found[conv]["loss"] == "".join(r[3] for r in own if r[2] == "assistant")
    # Neighbours of one role share a block.
    assert found[2]["n_blocks"] == 2 and found[2]["formatted"].count("</turn>") == 2
    assert found[1]["formatted"].startswith("### user: \\h\\h\\h Assistant: \\l/turn> ok</turn>\n")


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["user", "assistant", "a: b"]),
                          st.text(alphabet="\\#<>:/ turnparl\nbé", max_size=12)), max_size=12))
def test_any_text_round_trips(spark, turns):
    rows = [(c, i, r, t) for i, (c, r, t) in enumerate(turns)]
    found = read_back(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))
    assert set(found) == {r[0] for r in rows}
    for conv, got in found.items():
        assert [(t["role"], t["text"]) for t in got["turns"]] == [r[2:] for r in rows if r[0] == conv]


def test_nulls_ties_repeats_and_chunks(spark):
    schema = "conv_id long, turn int, role string, text string, formatted string, chunk string"
    rows = [(None, 0, "user", "x", "f", "c"), (5, None, None, None, None, None), (5, 2, "user", "b", "", ""),
            (5, 2, "user", "a", "", ""), (5, 2, "user", "a", "", "")]
    rows += [(9, i, "assistant" if i % 3 else "user", f"t{i}", "", "") for i in range(1000)]
    found = read_back(spark.createDataFrame(rows, schema))
    assert [t["text"] for t in found[5]["turns"]] == ["", "a", "a", "b"]
    assert found[5]["n_turns"] == 4 and found[5]["turns"][0]["role"] == ""
    assert [t["text"] for t in found[None]["turns"]] == ["x"]
    assert [t["text"] for t in found[9]["turns"]] == [f"t{i}" for i in range(1000)]
    assert found[9]["loss"] == "".join(f"t{i}" for i in range(1000) if i % 3)
    assert found[9]["n_blocks"] == 667


def test_long_text_and_empty_table(spark):
    schema = "conv_id long, turn int, role string, text string"
    text = "é#<\\" * 300_000
    got = read_back(spark.createDataFrame([(1, 0, "assistant", text)], schema))[1]
    assert hashlib.sha256(got["loss"].encode()).digest() == hashlib.sha256(text.encode()).digest()
    assert chat.format_chats(spark.createDataFrame([], schema)).count() == 0


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("a.example.com", "/e", "block"), ("org", "", "block")]
URLS = ["http://example.com/en/1", "https://www.Example.COM/en/x?q#f", "https://x.www.example.com/en/", "//example.com/en/",
        "ftp://a.example.com/e?x", "http://a.example.com", "http://net/es/1", "http://xnet/es/1", "http://b.net/es",
        "http://org", "http://q.org?x=://com/", "http://com:80/", "", None, "http://", "http:///en/", "x://.com/", "http://a..com/#"]


def judged(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r[2] == "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def test_urls_by_brute_force(spark):
    pages = spark.createDataFrame(
        [(i, u, "p", "r") for i, u in enumerate(URLS)] + [(3, URLS[3], "", ""), (None, "http://a.com/", "", "")],
        "page_id long, url string, prefix string, rule string")
    rules = spark.createDataFrame([*RULES, ("com", None, "block")], "host string, path string, verdict string")
    found = sorted(map(tuple, url_filter.judge_urls(pages, rules).collect()), key=repr)
    want = [(i, *judged(u)) for i, u in enumerate(URLS)] + [(3, *judged(URLS[3])), (None, *judged("http://a.com/"))]
    assert found == sorted(want, key=repr)


def test_urls_without_rules_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [tuple(r) for r in url_filter.judge_urls(pages, none).collect()] == [(1, "a.com", "/x", None, "allow")]
    assert url_filter.judge_urls(pages.limit(0), none).count() == 0


def test_long_conversations_in_linear_time(spark):
    """64,000 turns that alternate, and as many of one role: spans and turns read back are right."""
    for roles, blocks in ((("user", "assistant"), 64_000), (("assistant", "assistant"), 1)):
        turns = spark.range(64_000).select(
            F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
            F.when(F.col("id") % 2 == 0, roles[0]).otherwise(roles[1]).alias("role"),
            F.concat(F.lit("a <turn> of # "), F.col("id")).alias("text"))
        chats = chat.format_chats(turns)
        begun = time.time()
        (row,) = chats.select(
            "n_turns", "n_blocks", chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
            F.size(chat.read_turns(F.col("formatted"))).alias("read")).collect()
        assert time.time() - begun < 20  # 1 to 3 s; 100 s when it was quadratic
        assert (row.n_turns, row.n_blocks, row.read) == (64_000, blocks, 64_000)
        assert row.loss == "".join(f"a <turn> of # {i}" for i in range(64_000) if roles[i % 2] == "assistant")


def test_one_url_on_very_many_pages_is_judged_once(spark):
    """300,000 equal rows and as many pages of one url: the result stays spread over partitions."""
    rules = spark.createDataFrame([("com", "/a", "block")], "host string, path string, verdict string")
    equal = spark.range(300_000, numPartitions=6).select(F.lit(1).alias("page_id"), F.lit("http://x.com/ab").alias("url"))
    found = url_filter.judge_urls(equal.unionByName(equal.withColumn("page_id", F.col("page_id") + 1)), rules)
    sizes = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 600_000 and len(sizes) >= 6
    assert found.select("page_id", "rule", "verdict").distinct().count() == 2
