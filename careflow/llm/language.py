"""Language identification by cross-parsing.

Labelled text of each language becomes a suffix automaton.  A text is parsed with each into the
longest phrases that occur in the labelled text; the language that needs the fewest phrases for
its characters, each weighed by the bits that point into its labelled text, wins.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.llm.common import broadcast_if_small, cut, fold, in_tasks, text_rows, texts_of

#: Bounds of the labelled sample: documents and bytes of each language.
SAMPLE_DOCS = 64
SAMPLE_BYTES = 16384
#: A language's documents are drawn from so many shares side by side.
SHARES = 16
#: From so much labelled text on the length of phrases tells whether a text is in the language at all.
KNOWN_BYTES = 2048
#: A text is parsed in pieces of so many bytes, side by side; a phrase ends with its piece.
PIECE = 256
LANES = 1 << 14
#: Languages whose automata a worker holds at once.
AT_ONCE = 64
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


class Parser(NamedTuple):
    """Languages with their automata over one alphabet of byte classes.

    ``steps[l]`` has the number of states, the places ``state + class`` that go on, and their next
    states, each a multiple of the alphabet's size; 0 is the start.  A language takes less than 0.5 MB
    so; its whole table is made when it is used.
    """

    languages: list[str]
    bits: np.ndarray
    classes: bytes
    steps: list[tuple[int, np.ndarray, np.ndarray]]
    width: int

    def table(self, language: int) -> np.ndarray:
        """Next state of each ``state + class``; 0 says that the phrase can't go on."""
        states, places, following = self.steps[language]
        table = np.zeros(states * self.width, np.int32)
        table[places] = following
        return table


def plain(text: str) -> bytes:
    """Lower case, anything in ASCII but letters blank."""
    return text.lower().encode("utf-8", "replace").translate(_BLANK)


_BLANK = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def suffix_automaton(symbols: bytes, width: int) -> tuple[int, np.ndarray, np.ndarray]:
    """States and steps over ``width`` symbols: a path from the start spells each substring."""
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for symbol in symbols:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in step[at]:
            step[at][symbol] = new
            at = link[at]
        if at >= 0:
            to = step[at][symbol]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                twin = len(step)
                step.append(dict(step[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                link[to] = link[new] = twin
                while at >= 0 and step[at].get(symbol) == to:
                    step[at][symbol] = twin
                    at = link[at]
        last = new
    places = [state * width + symbol for state, ways in enumerate(step) for symbol in ways]
    following = [to * width for ways in step for to in ways.values()]
    return len(step), np.array(places, np.int32), np.array(following, np.int32)


def beginning(text: bytes, size: int) -> bytes:
    """Whole characters of at most ``size`` bytes."""
    return text[:size].decode("utf-8", "ignore").encode()


def learn(samples: dict[str, str], size: int = SAMPLE_BYTES) -> Parser:
    texts = {name: beginning(plain(text), size) for name, text in sorted(samples.items())}
    texts = {name: text for name, text in texts.items() if text.strip()}
    seen = sorted(set(b"".join(texts.values())))
    classes = bytearray(256)  # class 0: bytes that no sample has
    for i, byte in enumerate(seen):
        classes[byte] = i + 1
    width = len(seen) + 1
    return Parser(
        list(texts), np.array([math.log2(max(2, len(t))) for t in texts.values()]), bytes(classes),
        [suffix_automaton(t.translate(bytes(classes)), width) for t in texts.values()], width)


def count_phrases(lanes: np.ndarray, sizes: np.ndarray, steps: np.ndarray, width: int) -> np.ndarray:
    """Phrases of each lane (rows of ``lanes``, of ``sizes`` bytes, longest first)."""
    columns = np.ascontiguousarray(lanes.T).astype(np.int32)
    state, phrases = np.zeros(len(lanes), np.int32), np.zeros(len(lanes), np.int64)
    active = np.searchsorted(-sizes, -np.arange(lanes.shape[1]), side="left")
    for t in range(lanes.shape[1]):
        k = active[t]
        if not k:
            break
        symbol = columns[t, :k]
        following = steps.take(state[:k] + symbol)
        stuck = np.flatnonzero(following == 0)
        restart = steps.take(symbol[stuck])
        # The phrase that can't go on ends here; a byte that starts none is a phrase itself.
        phrases[stuck] += (state[stuck] != 0).astype(np.int64) + (restart == 0)
        following[stuck] = restart
        state[:k] = following
    return phrases + (state != 0)


def _costs(texts: list[bytes], parser: Parser) -> Iterator[np.ndarray]:
    """Bits for each byte of each text, language after language."""
    sizes = np.array([len(t) for t in texts], np.int64)
    pieces = -(-sizes // PIECE)
    buffer = np.zeros(int(pieces.sum()) * PIECE, np.uint8)
    at = np.cumsum(pieces) - pieces
    for text, start in zip(texts, at.tolist(), strict=True):
        buffer[start * PIECE:start * PIECE + len(text)] = np.frombuffer(text.translate(parser.classes), np.uint8)
    lanes = buffer.reshape(-1, PIECE)
    owner = np.repeat(np.arange(len(texts)), pieces)
    lane_size = np.minimum(PIECE, sizes[owner] - (np.arange(len(lanes)) - at[owner]) * PIECE)
    orders = [start + np.argsort(-lane_size[start:start + LANES], kind="stable") for start in range(0, len(lanes), LANES)]
    for language, bits in enumerate(parser.bits):
        steps, total = parser.table(language), np.zeros(len(texts))
        for order in orders:
            phrases = count_phrases(lanes[order], lane_size[order], steps, parser.width)
            total += np.bincount(owner[order], phrases, minlength=len(texts))
        yield total * bits / np.maximum(sizes, 1)


def costs(texts: list[bytes], parser: Parser) -> np.ndarray:
    """Bits for each byte of each text (rows) in each language."""
    return np.column_stack([*_costs(texts, parser)] or [np.empty((len(texts), 0))])


def two_lowest(texts: list[bytes], parser: Parser) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The language of the lowest cost of each text, the first of equal ones, that cost, and the next."""
    best = np.zeros(len(texts), np.int64)
    lowest, second = np.full(len(texts), np.inf), np.full(len(texts), np.inf)
    for language, cost in enumerate(_costs(texts, parser)):
        lower = cost < lowest
        second = np.where(lower, lowest, np.minimum(second, cost))
        best[lower], lowest = language, np.where(lower, cost, lowest)
    return best, lowest, second


def labelled_pieces(docs: DataFrame, held_out: int, parts: int) -> DataFrame:
    """``lang, doc_id, share, piece``: pieces of labelled text, from documents outside the held-out fold.

    All languages; bounded: ``SAMPLE_DOCS`` documents of each (those of the smallest id hashes; rows that
    repeat an id are one document), from each a piece at a hashed place.  All share ``SAMPLE_BYTES`` alike.
    """
    rows = docs.select("doc_id", "lang", "text").where(
        F.col("lang").isNotNull() & (F.length("text") > 0) & (fold(F.col("doc_id"), parts) != held_out))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    # In two steps, so that no task gets some of a language from every other.
    share = F.pmod(F.xxhash64("doc_id", F.lit("share")), F.lit(SHARES))
    few = (
        rows.select("lang", "doc_id").distinct().withColumn("part", share)
        .withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
        .where(F.col("place") <= SAMPLE_DOCS)
    )
    chosen = (
        few.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
        .where(F.col("place") <= SAMPLE_DOCS)
        # A blank parts the pieces.
        .select("lang", "doc_id", (F.expr(f"{SAMPLE_BYTES} div count(*) OVER (PARTITION BY lang)") - 1).alias("share"))
    )
    piece = F.col("share").cast("int")
    start = F.pmod(F.xxhash64("text"), F.greatest(F.lit(1), F.length("text") - piece)) + 1
    return (
        rows.join(broadcast_if_small(cut(chosen)), ["lang", "doc_id"])
        .select("lang", "doc_id", "share", F.col("text").substr(start.cast("int"), piece).alias("piece"))
        .groupBy("lang", "doc_id", "share").agg(F.min("piece").alias("piece"))
    )


def joined(pieces: DataFrame) -> dict[str, str]:
    """The labelled text of each language: at most ``SAMPLE_BYTES`` of it."""
    samples: dict[str, list[str]] = {}
    for row in sorted(pieces.collect(), key=lambda r: (r["lang"], r["doc_id"])):
        samples.setdefault(row["lang"], []).append(beginning(plain(row["piece"]), row["share"]).decode())
    return {name: " ".join(texts) for name, texts in samples.items()}


def labelled_samples(docs: DataFrame, held_out: int, parts: int) -> dict[str, str]:
    return joined(labelled_pieces(docs, held_out, parts))


def has_letter(text: str) -> bool:
    return any(found.group().isalpha() for found in LETTER.finditer(text))


def identify(docs: DataFrame, held_out: int = 1, parts: int = 3, carry: bool = False) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, phrase`` for every row of ``docs`` (``doc_id, text, lang``), and with
    ``carry`` the whole input row as ``row``.

    Learns from labelled rows whose fold (crc32 of the id modulo ``parts``) is not ``held_out``; rows
    with a null id are not learned from and count as not held out, rows that repeat an id are learned from
    as one.  ``lang_pred`` is ``und`` with score 0 if the text is null, empty or has no letter, or if nothing
    could be learned.  Else ``score`` is the runner-up's share of the two lowest costs (0.5: a tie, settled by
    code point; 1: only one language), and ``phrase`` the bytes of an average phrase in the language: about
    1 if the text is nothing like it, null if less than ``KNOWN_BYTES`` of the language could be learned.  Long texts are parsed in pieces of ``PIECE`` bytes, where phrases end.
    Repeated rows stay; other columns, whatever their names, are ignored; an empty table gives no row.

    Every text is parsed in each language, so time goes with their number.  ``AT_ONCE`` languages (0.5 MB
    each at most) are sent to the workers at once; more come in rounds, between which texts are written.
    """
    spark = docs.sparkSession
    pieces = cut(labelled_pieces(docs, held_out, parts))
    names = sorted(r[0] for r in pieces.select("lang").distinct().collect())
    out = F.coalesce(fold(F.col("doc_id"), parts) == held_out, F.lit(False))
    rows = text_rows(docs, out, carry)
    source, state = rows.schema, T.StructType([*rows.schema.fields, *_STATE])
    told = rows.select(*rows.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in _STATE])
    for at in range(0, max(1, len(names)), AT_ONCE):
        block = names[at:at + AT_ONCE]
        samples = joined(pieces.where(F.col("lang").isin(block))) if len(names) > AT_ONCE else joined(pieces)
        told = in_tasks(cut(told) if at else told, _told(spark.sparkContext.broadcast(learn(samples)), source, state), state)
    known = F.col("_name").isNotNull()
    second = F.col("_second")
    return told.select(
        "doc_id", "held_out", F.coalesce("_name", F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(~known, 0.0).when(second.isNull(), 1.0).otherwise(second / (second + F.col("_lowest"))).alias("score"),
        F.when(F.col("_bits") >= math.log2(KNOWN_BYTES), F.col("_bits") / F.col("_lowest")).alias("phrase"), *(["row"] if carry else []))


#: What rounds hand on: the language of the lowest cost, that of its phrases, the cost, and the next one.
_STATE = [
    T.StructField("_name", T.StringType()), T.StructField("_bits", T.DoubleType()),
    T.StructField("_lowest", T.DoubleType()), T.StructField("_second", T.DoubleType())]


def _told(shared: Broadcast, source: T.StructType, state: T.StructType):
    """One round: parses texts that have a letter, and keeps the lower of the costs so far and its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = shared.value
        for batch in batches:
            if not parser.languages:
                yield batch
                continue
            texts = [t.as_py() or "" for t in texts_of(batch, source)]
            known = np.array([has_letter(t) for t in texts], bool)
            found = two_lowest([plain(t) if k else b"" for t, k in zip(texts, known, strict=True)], parser)
            best, lowest, second = found
            names, bits, before, next_ = (batch.column(i) for i in range(3, 7))
            earlier, runner_up = (np.nan_to_num(c.to_numpy(zero_copy_only=False), nan=np.inf) for c in (before, next_))
            own = known & (lowest < earlier)
            second = np.where(own, np.minimum(second, earlier), np.minimum(runner_up, lowest))
            kept = [parser.languages[b] if o else n for b, o, n in zip(best, own, names.to_pylist(), strict=True)]
            old = np.nan_to_num(bits.to_numpy(zero_copy_only=False))
            columns = (np.where(own, parser.bits[best], old), np.where(own, lowest, earlier), second)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(kept, pa.string()),
                 *(pa.array(c, pa.float64(), mask=~known | ~np.isfinite(c)) for c in columns)], state.names)

    return run
