"""Collocations by best-first branch and bound over phrase prefixes.

A phrase of 2 to 4 words that occurs ``LEAST`` times or more is a candidate.
Every cut into a first part and a rest gives ``2000000 * a / (l + r)`` from the
counts of the phrase and of both parts; the lowest cut is its score.

The corpus is read once: a block of about ``BLOCK`` bytes becomes its distinct
words with their counts, and its text as places in that list. Word counts are
summed over the blocks, words that occur often enough get a number by falling
count, and numbers and counts go back to the blocks, whose texts from then on
are numbers with a mark where no phrase can pass. Later rounds read only these.

Phrases grow to the right. No phrase is more frequent than its prefix, and each
of its parts is at least as frequent as itself, so a prefix ``q`` that starts
with ``w`` bounds the score of all that grows from it by
``2000000 * f(q) / (f(w) + f(q))``. A round expands, best first, all prefixes
whose bound reaches the language's threshold: two words, three, four. One more
reading counts what the best candidates still lack: the rests of their cuts,
and whatever stands right before them, for the rule by which a phrase inside a
longer one of nearly its count is dropped. After a round all candidates whose
score reaches the threshold are known with their fate. A language is settled
when as many survive as are wanted, as none below the threshold can tie with
them, or when the threshold is zero. The others go on with a lower one.

Blocks add up their own n-grams first, and n-grams are two 64-bit numbers, so
shuffles carry short rows of which a block has each at most once. Prefixes that
are to grow reach the tasks as a table of ``2**BITS`` bits, whose size does not
depend on the corpus: one that is set by chance only counts an n-gram more.
Scores are decimals of 38 digits.

Defined results: A-Z is lower-cased; a null text is empty, a null language is
``und``; documents without words add nothing, not even a language. Repeated
rows count as often as they stand there. Ties are ordered by count and then by
the bytes of the phrase. An empty table gives no rows. Fewer than 2**31 words
may be frequent; more are an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from fiscalframe.llm.shared import packed_numbers, stored, unpacked_numbers, with_position

LEAST = 30
WANTED = 2000
SCALE = 2_000_000
#: A phrase inside a longer one of so many percent of its count is dropped.
COVERED = 80
#: Bytes of text in a block.
BLOCK = 3 << 20
#: The table of prefixes has 2**BITS bits.
BITS = 24
#: Thresholds of the rounds, as scores. A language with few frequent words starts at the last.
THRESHOLDS = (400_000, 40_000, 4_000, 0)
FEW_WORDS = 2 * WANTED

_BREAK = 0xFFFFFFFF
_UPPER = bytes(range(65, 91))
_MARKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_UPPER + _MARKS + b"\t", _UPPER.lower() + b"\n" * len(_MARKS) + b" ")


def _coded_texts(texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words of some texts, their counts, and all texts as places in them, with marks between pieces."""
    data = b"\n".join(texts).translate(_TABLE)
    codes, found = pd.factorize(np.array(data.replace(b"\n", b" \n ").split(b" "), dtype=object))
    found = list(found)
    # White space leaves empty words behind.
    place = np.full(len(found), -2, np.int64)
    words = [i for i, w in enumerate(found) if w not in (b"", b"\n")]
    place[words] = np.arange(len(words))
    if b"\n" in found:
        place[found.index(b"\n")] = -1
    tokens = place[codes]
    tokens = tokens[tokens != -2]
    counts = np.bincount(tokens[tokens >= 0], minlength=len(words))
    return [found[i].decode("utf-8") for i in words], counts, _single_marks(tokens)


def _single_marks(tokens: np.ndarray) -> np.ndarray:
    """Without marks at the ends or behind marks."""
    keep = (tokens >= 0) | np.append(False, tokens[:-1] >= 0)
    return tokens[keep]


def encoded(documents: DataFrame) -> DataFrame:
    """``block, lang, words, counts, tokens``: a row for each block of texts of one language."""

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, size, held = TaskContext.get().partitionId() << 32, 0, {}
        for part in parts:
            for lang, text in zip(part["lang"], part["text"], strict=True):
                held.setdefault(lang, []).append(text)
                size += len(text)
                if size >= BLOCK:
                    yield from told(block, held)
                    block, size, held = block + len(held), 0, {}
        yield from told(block, held)

    def told(block: int, held: dict[str, list[bytes]]) -> Iterator[pd.DataFrame]:
        for i, (lang, texts) in enumerate(held.items()):
            words, counts, tokens = _coded_texts(texts)
            row = (block + i, lang, words, counts, packed_numbers(tokens & _BREAK))
            yield pd.DataFrame([row], columns=["block", "lang", "words", "counts", "tokens"])

    texts = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").cast("binary").alias("text"))
    texts = texts.filter(F.octet_length("text") > 0)
    return stored(texts.mapInPandas(rows, "block long, lang string, words array<string>, counts array<long>, tokens binary"), "encoded")


def word_entries(blocks: DataFrame) -> DataFrame:
    """``block, lang, place, word, n``: the words of every block."""
    each = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "of"))
    return each.select("block", "lang", "place", F.col("of.words").alias("word"), F.col("of.counts").alias("n"))


def frequent_words(entries: DataFrame) -> DataFrame:
    """``id, lang, word, f`` of the words that occur often enough, numbered from 0 by falling count."""
    counted = entries.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= LEAST)
    return stored(with_position(counted, [F.col("f").desc(), F.col("lang"), F.col("word")], "id"), "words")


def numbered(blocks: DataFrame, entries: DataFrame, words: DataFrame) -> DataFrame:
    """``lang, ids, f, tokens``: blocks whose texts are places among the frequent words that they hold."""
    known = entries.select("block", "lang", "place", "word").join(words.hint("merge"), ["lang", "word"])
    known = known.select(F.col("block").alias("to"), "place", "id", "f")

    def rows(own: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        held, first = held.sort_values("id"), own.iloc[0]
        tokens = unpacked_numbers(first["tokens"])
        place = np.full(first["n_words"] + 1, -1, np.int64)
        place[held["place"].to_numpy()] = np.arange(len(held))
        tokens = _single_marks(place[np.where(tokens == _BREAK, len(place) - 1, tokens)])
        ids, f = (held[c].to_numpy("<i8").tobytes() for c in ("id", "f"))
        return pd.DataFrame([(first["lang"], ids, f, packed_numbers(tokens & _BREAK))], columns=["lang", "ids", "f", "tokens"])

    own = blocks.select("block", "lang", F.size("words").alias("n_words"), "tokens")
    pairs = own.groupBy("block").cogroup(known.groupBy("to"))
    return stored(pairs.applyInPandas(rows, "lang string, ids binary, f binary, tokens binary"), "numbered")


# --- n-grams -------------------------------------------------------------------
# Words are numbers from 1 here and 0 where there is none: the first two in p, the others in q.


def _upper(x: Column) -> Column:
    return F.shiftright(x, 32)


def _lower(x: Column) -> Column:
    return x.bitwiseAND(F.lit(0xFFFFFFFF))


def _two(a: Column, b: Column | int) -> Column:
    return F.shiftleft(a, 32).bitwiseOR(b if isinstance(b, Column) else F.lit(b).cast("long"))


def gram_words(p: str = "p", q: str = "q") -> list[Column]:
    return [_upper(F.col(p)), _lower(F.col(p)), _upper(F.col(q)), _lower(F.col(q))]


def gram(*words: Column) -> tuple[Column, Column]:
    w = [*words, *[F.lit(0).cast("long")] * (4 - len(words))]
    return _two(w[0], w[1]), _two(w[2], w[3])


def gram_length() -> Column:
    return sum(((w > 0).cast("int") for w in gram_words()), F.lit(0))


def _bit(p: np.ndarray, q: np.ndarray, bits: int) -> np.ndarray:
    x = p.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ q.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ x >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ x >> np.uint64(29)) >> np.uint64(64 - bits)


def bit_table(grams: DataFrame):
    """The bits of all ``(p, q)`` as a broadcast of 2**BITS bits."""
    size = BITS

    def cells(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts:
            at = np.unique(_bit(b["p"].to_numpy(), b["q"].to_numpy(), size)).astype(np.int64)
            cell, first = np.unique(at >> 6, return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first) if len(at) else np.zeros(0, np.uint64)
            yield pd.DataFrame({"cell": cell, "bits": bits.view(np.int64)})

    held = grams.select("p", "q").mapInPandas(cells, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toPandas()
    table = np.zeros(1 << (size - 6), np.uint64)
    table[held["cell"].to_numpy()] = held["bits"].to_numpy().view(np.uint64)
    return grams.sparkSession.sparkContext.broadcast(table)


def _held(table: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    bit = _bit(p, q, len(table).bit_length() + 5)
    return table[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1) == 1


class _Runs:
    """The n-grams of one block: places of frequent words, and the windows that no mark interrupts."""

    def __init__(self, row) -> None:
        self.ids, self.f = np.frombuffer(row.ids, "<i8") + 1, np.frombuffer(row.f, "<i8")
        tokens = unpacked_numbers(row.tokens)
        self.tokens = np.where(tokens == _BREAK, -1, tokens)

    def starts(self, length: int) -> np.ndarray:
        known = self.tokens >= 0
        last = len(known) - length + 1
        if last <= 0:
            return np.zeros(0, np.int64)
        return np.nonzero(np.logical_and.reduce([known[i : last + i] for i in range(length)]))[0]

    def keys(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        w = [self.ids[self.tokens[at + i]] if i < length else np.zeros(len(at), np.int64) for i in range(4)]
        return w[0] << 32 | w[1], w[2] << 32 | w[3]

    def counted(self, at: np.ndarray, length: int) -> pd.DataFrame:
        """Distinct n-grams at these places and how often each is there."""
        code = np.zeros(len(at), np.int64)
        for i in range(length):
            # Places among distinct prefixes stay below the number of tokens, so the code fits.
            code = np.unique(code * len(self.ids) + self.tokens[at + i], return_inverse=True)[1] if i else self.tokens[at]
        _, first, n = np.unique(code, return_index=True, return_counts=True)
        p, q = self.keys(at[first], length)
        return pd.DataFrame({"p": p, "q": q, "n": n})


def _scan(blocks: DataFrame, find: Callable[[_Runs, float], Iterator[tuple[np.ndarray, int]]]) -> DataFrame:
    """``p, q, n`` of the n-grams that ``find`` names the places of, over all blocks."""

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for row in part.itertuples(index=False):
                runs = _Runs(row)
                for at, length in find(runs, row.threshold):
                    yield runs.counted(at, length)

    counted = blocks.mapInPandas(rows, "p long, q long, n long")
    return counted.groupBy("p", "q").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST)


def _pairs_in_bound(runs: _Runs, threshold: float) -> Iterator[tuple[np.ndarray, int]]:
    """Two words can only be a prefix within the bound if the rarer one is frequent enough beside the first."""
    at = runs.starts(2)
    first, second = runs.f[runs.tokens[at]], runs.f[runs.tokens[at + 1]]
    least = np.minimum(first, second).astype(float)
    # The margin covers rounding, so nothing within the bound is left out.
    yield at[SCALE * least * (1 + 1e-9) >= threshold * (first + least)], 2


def _growing(table, length: int):
    def find(runs: _Runs, threshold: float) -> Iterator[tuple[np.ndarray, int]]:
        at = runs.starts(length)
        yield at[_held(table.value, *runs.keys(at, length - 1))], length

    return find


def _lacking(rests, inner):
    """Rests of cuts, and phrases with one more word in front."""

    def find(runs: _Runs, threshold: float) -> Iterator[tuple[np.ndarray, int]]:
        for length in (2, 3, 4):
            at = runs.starts(length)
            wanted = np.zeros(len(at), bool)
            if length < 4:
                wanted |= _held(rests.value, *runs.keys(at, length))
            if length > 2:
                wanted |= _held(inner.value, *runs.keys(at + 1, length - 1))
            yield at[wanted], length

    return find


def _reaches(n: Column, side: Column) -> Column:
    """``2000000 * n / (side + n)`` reaches the threshold, in exact numbers."""
    wide = lambda x: x.cast("decimal(19,0)")
    return F.lit(SCALE).cast("decimal(7,0)") * wide(n) >= F.col("threshold").cast("decimal(7,0)") * (wide(side) + wide(n))


def _with_ends(grams: DataFrame, words: DataFrame) -> DataFrame:
    """Counts of the first and the last word, and the language's threshold."""
    w = gram_words()
    last = F.when(w[3] > 0, w[3]).when(w[2] > 0, w[2]).otherwise(w[1])
    ends = grams.withColumn("first", w[0] - 1).withColumn("last", last - 1)
    one = words.select(F.col("id").alias("first"), F.col("f").alias("f_first"), "lang", "threshold")
    other = words.select(F.col("id").alias("last"), F.col("f").alias("f_last"))
    return ends.join(one.hint("merge"), "first").join(other.hint("merge"), "last").drop("first", "last")


def _round(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """``p, q, lang, threshold, a, l, r, score`` of all surviving candidates whose score reaches their language's threshold."""
    two = stored(_with_ends(_scan(blocks, _pairs_in_bound), words), "two")
    prefix = two.filter(_reaches(F.col("n"), F.col("f_first")))
    three = stored(_with_ends(_scan(blocks, _growing(bit_table(prefix), 3)), words), "three")
    prefix = three.filter(_reaches(F.col("n"), F.col("f_first")))
    four = stored(_with_ends(_scan(blocks, _growing(bit_table(prefix), 4)), words), "four")
    grown = two.unionByName(three).unionByName(four)
    # A first part is no rarer than the phrase, nor is a rest.
    likely = grown.filter(_reaches(F.col("n"), F.col("f_first")) & _reaches(F.col("n"), F.col("f_last")))
    likely = stored(likely.select("p", "q", "n", "lang", "threshold"), "likely")

    w = gram_words()
    rests = F.array(F.struct(*_named(gram(w[1], w[2], w[3]))), F.struct(*_named(gram(w[2], w[3]))))
    rests = likely.filter(gram_length() >= 3).select(F.explode(rests).alias("of")).select("of.*").filter(gram_length() >= 2)
    more = _scan(blocks, _lacking(bit_table(rests), bit_table(likely.filter(gram_length() <= 3))))
    counts = stored(grown.select("p", "q", "n").unionByName(more).groupBy("p", "q").agg(F.max("n").alias("n")), "counts")
    return stored(_scored(likely, counts, words), "scored")


def _named(key: tuple[Column, Column]) -> list[Column]:
    return [key[0].alias("p"), key[1].alias("q")]


def _parts() -> Column:
    """For every cut both parts of a candidate, with the number of words in the first."""
    w, length = gram_words(), gram_length()

    def part(k: int, first: bool, *words: Column) -> Column:
        p, q = gram(*words)
        return F.struct(F.lit(k).alias("k"), F.lit(first).alias("is_first"), p.alias("part_p"), q.alias("part_q"))

    cuts = [(part(k, True, *w[:k]), part(k, False, *w[k:])) for k in (1, 2, 3)]
    return F.filter(F.array(*[x for both in cuts for x in both]), lambda x: x["k"] < length)


def _scored(likely: DataFrame, counts: DataFrame, words: DataFrame) -> DataFrame:
    single = words.select(*_named(gram(F.col("id") + 1)), F.col("f").alias("n"))
    known = single.unionByName(counts.select("p", "q", "n"))
    known = known.select(F.col("p").alias("part_p"), F.col("q").alias("part_q"), F.col("n").alias("of"))
    own = ["p", "q", "n", "lang", "threshold"]
    cut = likely.select(*own, F.explode(_parts()).alias("c")).select(*own, "c.*")
    # A part is no key of many rows on the other side; its own rows may be many, and are split.
    found = cut.join(known.hint("merge"), ["part_p", "part_q"])
    sides = found.groupBy(*own, "k").agg(F.max(F.when(F.col("is_first"), F.col("of"))).alias("l"), F.max(F.when(~F.col("is_first"), F.col("of"))).alias("r"))
    score = F.expr(f"(cast({SCALE} as decimal(7,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    lowest = sides.withColumn("score", score).groupBy(*own).agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    lowest = lowest.filter(F.col("cut.score") >= F.col("threshold"))

    w = gram_words()
    longer = counts.filter(gram_length() >= 3)
    tail, length = gram(*w[1:]), gram_length()
    head_p, head_q = gram(w[0], w[1], F.when(length == 4, w[2]).otherwise(F.lit(0).cast("long")))
    inner = F.explode(F.array(F.struct(*_named(tail)), F.struct(head_p.alias("p"), head_q.alias("q"))))
    covers = longer.select("n", inner.alias("of")).groupBy("of.p", "of.q").agg(F.max("n").alias("longer"))
    judged = lowest.join(covers.hint("merge"), ["p", "q"], "left")
    wide = lambda x: x.cast("decimal(19,0)") * F.lit(100).cast("decimal(3,0)")
    limit = F.col("n").cast("decimal(19,0)") * F.lit(COVERED).cast("decimal(3,0)")
    alone = F.col("longer").isNull() | (wide(F.col("longer")) < limit)
    return judged.filter(alone).select("p", "q", "lang", "threshold", F.col("n").alias("a"), "cut.l", "cut.r", "cut.score")


def collocations(documents: DataFrame, wanted: int = WANTED) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``wanted`` surviving phrases."""
    blocks = encoded(documents)
    entries = word_entries(blocks)
    words = frequent_words(entries)
    if (words.agg(F.max("id")).first()[0] or 0) >= (1 << 31) - 2:
        raise ValueError("more than 2**31 frequent words")
    totals = stored(entries.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    texts = numbered(blocks, entries, words)

    sizes = words.groupBy("lang").agg(F.count("*").alias("n_words"))
    threshold = F.when(F.col("n_words") < 2 * wanted, THRESHOLDS[-1]).otherwise(THRESHOLDS[0])
    open_ = stored(sizes.select("lang", threshold.cast("long").alias("threshold")), "open")
    settled = None
    while open_.limit(1).count():
        known = words.join(open_, "lang")
        scored = _round(texts.join(open_, "lang"), known)
        reached = open_.join(scored.groupBy("lang").agg(F.count("*").alias("n_scored")), "lang", "left")
        reached = stored(reached.select("lang", "threshold", (F.coalesce("n_scored", F.lit(0)) >= wanted).alias("enough")), "reached")
        done = scored.join(reached.filter("enough or threshold = 0").select("lang"), "lang", "left_semi")
        settled = done if settled is None else settled.unionByName(done)
        lower = F.coalesce(*[F.when(F.col("threshold") > t, t) for t in THRESHOLDS])
        open_ = stored(reached.filter("not enough and threshold > 0").select("lang", lower.cast("long").alias("threshold")), "open")
    if settled is None:
        return documents.sparkSession.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    # Only what may still be among the first needs its words.
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    first = stored(settled.withColumn("_rank", F.rank().over(by_score)).filter(F.col("_rank") <= wanted).drop("_rank", "threshold"), "first")
    each = first.select("p", "q", F.posexplode(F.array(*gram_words())).alias("at", "word_id")).filter("word_id > 0")
    spelt = each.join(words.select((F.col("id") + 1).alias("word_id"), "word").hint("merge"), "word_id")
    ordered = F.array_sort(F.collect_list(F.struct("at", "word")))
    phrases = spelt.groupBy("p", "q").agg(F.array_join(F.transform(ordered, lambda x: x["word"]), " ").alias("phrase"))
    told = first.join(phrases, ["p", "q"]).join(totals, "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    out = told.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= wanted)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
