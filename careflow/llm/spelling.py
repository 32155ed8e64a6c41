"""Spelling variants: words one edit apart, found with bit sets per (position, letter) of a vocabulary.

A block of words is turned on its side: for each position and letter, one bit per word.  Going through a
query letter by letter, two kinds of sets are carried along: the words that agree so far, and the words
that agree but for one letter replaced, deleted or inserted, which look at the position of the letter, the
one before or the one after.  All queries of a block go at once, 64 words to a machine word.

A vocabulary is cut into cells first, so that not all words meet all: two words one edit apart share
a beginning or an end of about half their length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.llm.common import broadcast_if_small, cut, in_tasks

#: Words that a task counts before it hands them on, and characters of a text that are split at once.
WORDS, PIECE = 500_000, 1 << 20
#: A cell of more words than this for each letter left in them is divided further.
LIMIT = 1 << 18
#: Small cells are searched together, so many words at a time; bits in work at once.
BLOCK, CHUNK = 1024, 1 << 21
#: No bound on the beginning that two words of a cell may share.
OPEN = 1 << 30

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
_GAP = re.compile("[^A-Za-zÀ-ÿ]")
SHAPE = ["l", "p", "s", "cap", "key"]


def words_of(text: str) -> Iterator[list[bytes]]:
    """Runs of letters up to U+00FF, A-Z lower-cased, as Latin-1; a long text is split between runs."""
    start = 0
    while start < len(text):
        end = start + PIECE
        if end < len(text):
            gap = _GAP.search(text, end)
            end = gap.start() if gap else len(text)
        yield text[start:end].encode("latin-1", "replace").translate(_FOLD).split()
        start = end


def utf8(word: bytes) -> bytes:
    return word if word.isascii() else word.decode("latin-1").encode()


def count_words(texts: Iterator[tuple[object, str | None]], slip: int | None, least: int, limit: int) -> Iterator[Counter]:
    """Occurrences of words of at least ``least`` characters, of as many texts as ``limit`` words allow."""
    total: Counter[bytes] = Counter()
    for doc_id, text in texts:
        start = zlib.crc32(b"%s:" % ("" if doc_id is None else str(doc_id)).encode())
        for words in words_of(text or ""):
            found = Counter([w for w in words if len(w) >= least])
            total.update([w for w in words if len(w) >= least])
            for word in [w for w in found if slip and zlib.crc32(utf8(w), start) % slip == 0]:
                at = zlib.crc32(utf8(word), start) % len(word)
                total[word] -= found[word]
                if len(word) > least:
                    total[word[:at] + word[at + 1:]] += found[word]
        if len(total) >= limit:
            yield total
            total = Counter()
    yield total


def vocabulary(docs: DataFrame, length: int = 5, times: int = 3, slip: int | None = None) -> DataFrame:
    """``word, n``: the words of ``docs`` (``doc_id, text``) of at least ``length`` characters that occur at least
    ``times`` times.

    With ``slip``, an occurrence whose checksum (crc32 of ``doc_id:word``) it divides loses the letter that
    the checksum names, as a slip of the pen would; a null id is written as nothing.  Null text has no
    words; repeated rows count each; texts of any length are split in pieces; other columns are ignored.
    """
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((i, t.as_py()) for b in batches for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True))
        for total in count_words(rows, slip, length, WORDS):
            kept = [(w.decode("latin-1"), n) for w, n in total.items() if n > 0]
            for at in range(0, len(kept), 1 << 16):
                part = kept[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for w, _ in part], pa.string()), pa.array([n for _, n in part], pa.int64())], schema.names)

    counted = in_tasks(docs.select("doc_id", "text"), run, schema)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def near_words(middles: list[str], cells: np.ndarray, long: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word: how many words of its cell are one edit away, and the first of them (-1: none).

    ``middles`` of one cell have one length, or one letter more where ``long`` is set; of two long ones the
    distance is another cell's matter.  Words that share a beginning of ``cap`` letters or more are left out.
    """
    size, width = len(middles), max(map(len, middles), default=0)
    codes = np.array(middles, f"U{max(1, width)}").view(np.uint32).reshape(size, -1)
    alphabet, letters = np.unique(codes, return_inverse=True)
    letters = letters.reshape(codes.shape)
    lanes = -(-size // 64)

    def packed(bits: np.ndarray) -> np.ndarray:
        room = np.zeros((*bits.shape[:-1], lanes * 64), bool)
        room[..., :size] = bits
        return np.packbits(room, axis=-1, bitorder="little").view(np.uint64)

    # index[position, letter]: which words have that letter there.
    index = np.zeros((width + 1, len(alphabet), lanes), np.uint64)
    here = np.arange(size)
    for position in range(width):
        bits = np.zeros((len(alphabet), lanes * 64), bool)
        filled = codes[:, position] != 0
        bits[letters[filled, position], here[filled]] = True
        index[position] = np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)
    of_cell, is_long = packed(cells[None, :] == np.unique(cells)[:, None]), packed(long[None, :])[0]
    is_short = packed(~long[None, :])[0]
    counts, first = np.zeros(size, np.int64), np.full(size, -1, np.int64)
    cell_of = np.unique(cells, return_inverse=True)[1]
    for kind in (False, True):
        queries = np.flatnonzero(long == kind)
        step = max(1, CHUNK // (lanes * 64))
        for at in range(0, len(queries), step):
            chunk = queries[at:at + step]
            length = len(middles[chunk[0]])
            same = of_cell[cell_of[chunk]]
            replaced, deleted, inserted = (np.zeros_like(same) for _ in range(3))
            agreed = np.zeros_like(same)
            for i in range(length + 1):
                if i == cap:
                    agreed = same
                if i == length:
                    break
                letter = letters[chunk, i]
                now = index[i, letter]
                if kind:
                    deleted = (deleted & index[i - 1, letter] | same) if i else same
                else:
                    replaced = replaced & now | same & ~now
                    inserted = (inserted | same) & index[i + 1, letter]
                same = same & now
            found = deleted & is_short if kind else replaced & is_short | (inserted | same) & is_long
            found &= ~agreed
            counts[chunk] = np.bitwise_count(found).sum(axis=1)
            some = np.flatnonzero(counts[chunk])
            bits = np.unpackbits(found[some].view(np.uint8), axis=1, bitorder="little")
            first[chunk[some]] = bits.argmax(axis=1)
    return counts, first


def _search(batches: Iterator[pa.RecordBatch], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by cell; whole cells of one shape are searched together."""
    block: list[tuple[str, int, str, bool]] = []
    cells: list[int] = []
    cell, starts = (), 0

    def flush() -> Iterator[pa.RecordBatch]:
        if len(block) < 2:
            return
        # The most frequent word first, then by code points: the first one found is the best.
        order = sorted(range(len(block)), key=lambda i: (-block[i][1], block[i][0]))
        rows = [block[i] for i in order]
        counts, first = near_words(
            [r[2] for r in rows], np.array([cells[i] for i in order]), np.array([r[3] for r in rows]), cell[3] - cell[1])
        some = np.flatnonzero(counts).tolist()
        if some:
            best = [rows[first[i]] for i in some]
            yield pa.RecordBatch.from_arrays([
                pa.array([rows[i][0] for i in some], pa.string()), pa.array(counts[some]),
                pa.array([b[0] for b in best], pa.string()), pa.array([b[1] for b in best], pa.int64())], schema.names)

    for batch in batches:
        shapes = zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)
        rows = zip(*(batch.column(i).to_pylist() for i in range(5, 8)), strict=True)
        for shape, (word, n, middle) in zip(shapes, rows, strict=True):
            if shape != cell:
                # A cell of one word finds nothing.
                if block and len(block) - starts == 1:
                    block.pop()
                    cells.pop()
                if shape[:4] != cell[:4] or len(block) >= BLOCK:
                    yield from flush()
                    block, cells = [], []
                cell, starts = shape, len(block)
            block.append((word, n, middle, len(word) > shape[0]))
            cells.append(starts)
    yield from flush()


def _gap() -> Column:
    return F.col("l") - 1 - F.col("p") - F.col("s")


def divided(cells: DataFrame) -> DataFrame:
    """Each cell in two: words that share more of the beginning, and words that share more of the end.

    Two words one edit apart, the shorter of length ``l``, share a beginning and an end of ``l - 1`` letters
    together.  Those with the longer beginning are the first cell's; the second leaves them out (``cap``).
    """
    more = F.ceil(_gap() / 2).cast("int")
    first = F.struct(
        (F.col("p") + more).alias("p"), F.col("s"), F.col("cap"))
    second = F.struct(
        F.col("p"), (F.col("s") + _gap() - more + 1).alias("s"), F.least("cap", F.col("p") + more).alias("cap"))
    return keyed(cells.select("word", "n", "l", F.explode(F.array(first, second)).alias("part")).select("word", "n", "l", "part.*"))


def keyed(cells: DataFrame) -> DataFrame:
    word = F.col("word")
    return cells.select(
        "word", "n", "l", "p", "s", "cap",
        F.concat(word.substr(F.lit(1), F.col("p")), F.lit("\n"), word.substr(F.length(word) - F.col("s") + 1, F.col("s"))).alias("key"))


def cells_of(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``word, n`` and the cells it belongs to, none larger than ``limit`` words over the letters left in it.

    All words of a length and the next make a cell, which is divided once; what is still too large is
    divided again, until its words differ in one letter or two at most.  Then an alphabet of a letters
    allows no more than a + a * a words: for the 90 letters up to U+00FF 8,190.
    """
    length = F.length("word")
    cells = words.select(
        "word", "n", F.explode(F.filter(F.array(length, length - 1), lambda l: l > 0)).alias("l"),
        F.lit(0).alias("p"), F.lit(0).alias("s"), F.lit(OPEN).alias("cap"))
    single = keyed(cells.where(F.col("l") == 1))
    open_, done = divided(cells.where(F.col("l") > 1)), single
    while True:
        mark = F.xxhash64(*SHAPE)
        large = open_.where(_gap() > 0).groupBy(mark.alias("mark")).agg(F.count(F.lit(1)).alias("words"), F.max(_gap()).alias("gap"))
        large = cut(large.where(F.col("words") * (F.col("gap") + 2) > limit).select("mark"))
        if large.isEmpty():
            return done.unionByName(open_)
        large = broadcast_if_small(large)
        marked = open_.withColumn("mark", mark)
        # Marks that collide divide a small cell as well, which does no harm.
        rest = marked.join(large, "mark", "left_anti").unionByName(marked.join(large, "mark", "left_semi").where(_gap() <= 0))
        done = done.unionByName(rest.drop("mark"))
        open_ = divided(marked.join(large, "mark", "left_semi").where(_gap() > 0).drop("mark"))


def neighbours(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``word, n_near, best, best_n`` of each word that has another one edit away."""
    schema = T.StructType([
        T.StructField("word", T.StringType()), T.StructField("n_near", T.LongType()),
        T.StructField("best", T.StringType()), T.StructField("best_n", T.LongType())])
    middle = F.col("word").substr(F.col("p") + 1, F.length("word") - F.col("p") - F.col("s"))
    rows = cells_of(words, limit).select(*SHAPE, "word", "n", middle.alias("middle"))
    rows = rows.repartition(*SHAPE).sortWithinPartitions(*SHAPE)
    found = in_tasks(rows, lambda batches: _search(batches, schema), schema)
    first = F.min(F.struct((-F.col("best_n")).alias("order"), F.col("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first")).select(
        "word", "n_near", F.col("first.best").alias("best"), (-F.col("first.order")).alias("best_n"))


def roots_of(links: DataFrame) -> DataFrame:
    """``word, root`` from links ``word, form``, which form no ring: the end of each path.

    Every round the steps get twice as long.
    """
    steps = cut(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not steps.where("moved").isEmpty():
        further = steps.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        steps = cut(
            steps.join(further, F.col("root") == F.col("_at"), "left")
            .select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")))
    return steps.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = 2, limit: int = LIMIT) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``words`` (``word, n``).

    Near are words that differ by one inserted, deleted or replaced character; ``n_near`` counts them.  The
    ``form`` is the near word of the largest ``n``, the first in code-point order of equal ones, if that is
    at least ``ratio`` (over 1) times the word's own; else null.  ``root`` is where forms end, the word itself
    if it has none.  Rows with a null word or count or an empty word are left out, repeated words count as
    one with the sum; words of any length; other columns are ignored; an empty table gives no row.
    """
    counted = cut(
        words.where((F.col("word") != "") & F.col("n").isNotNull()).groupBy("word").agg(F.sum("n").cast("long").alias("n")))
    found = counted.join(neighbours(counted, limit), "word", "left")
    formed = cut(found.withColumn(
        "form", F.when(F.col("best_n") >= F.col("n") * ratio, F.col("best"))))
    roots = roots_of(formed.where(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"))
