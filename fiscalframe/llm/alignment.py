"""How the tokens of two tokenizers lie over the same text.

Texts are encoded a batch at a time: by a byte-level BPE (A), which gets a
space and the text, and by a piece model (B), which puts the space there
itself. Both cut at a single space between two visible characters whatever
stands around it: the pattern of A cannot match over one, and no piece of B
holds a space behind another character, which is checked when the model is
loaded. So texts are split there, a distinct unit is encoded once, and a very
long text takes no more memory in an encoder than a short one.

Tokens become byte ranges. ``pandas.merge_asof``, keyed by document, finds for
the start of each token the token of the other side that covers it. Two tokens
overlap if and only if one of them starts inside the other, so both directions
together give all overlaps. Offsets where tokens of both sides end cut a
document into groups, the smallest stretches that both sides cover whole.

Counting how often two ids are linked in the whole corpus needs no row per
link: a block of about ``BLOCK`` characters gathers its distinct pairs, only
these are shuffled and added up, and the sums go back to their block. An id
pair appears once per block, so the most frequent one makes a row per block,
and the join that brings its sum back can be split. The largest count per id
of B is a table of at most as many rows as B has ids; it is broadcast.

Defined results: a text that is null or empty, or whose tokens do not spell
the space and the text byte for byte, has no tokens. Every row has a result,
rows without id or with a repeated one included. An empty table gives none.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalframe.llm.shared import packed_numbers, stored, unpacked_numbers

#: Where the tokenizers lie; read by the driver, so executors need not have them.
TOKENIZERS = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
#: Characters that are encoded and aligned at a time, and those whose pairs are counted together.
BATCH = 1 << 20
BLOCK = 1 << 23

_UNIT = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")
_VISIBLE = re.compile(r"[!-~\w](.*[!-~\w])?", re.DOTALL)
_ENCODED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, block long, links binary, pairs array<long>, counts array<long>"


class Tokenizer(NamedTuple):
    """``encode`` turns texts, each standing behind a space, into ids; ``pieces`` has the bytes of every id."""

    encode: Callable[[list[str]], list[list[int]]]
    pieces: list[bytes]
    sizes: np.ndarray


class Aligned(NamedTuple):
    """Tokens of a batch of texts, in their order, and what lies over what.

    ``ids``, ``doc`` and ``end`` are pairs, A and B: token ids, the number of
    the text and the end in bytes of the batch. ``left`` and ``right`` are the
    places of linked tokens, ``group`` the number of each token's group.
    """

    ids: tuple[np.ndarray, np.ndarray]
    doc: tuple[np.ndarray, np.ndarray]
    end: tuple[np.ndarray, np.ndarray]
    left: np.ndarray
    right: np.ndarray
    group: tuple[np.ndarray, np.ndarray]


def _byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte: printable ones as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _tokenizer(encode: Callable[[list[str]], list[list[int]]], pieces: list[bytes]) -> Tokenizer:
    return Tokenizer(encode, pieces, np.fromiter(map(len, pieces), np.int64, len(pieces)))


@lru_cache(maxsize=4)
def byte_bpe(model: bytes) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already take all cores
    from tokenizers import Tokenizer as Bpe

    bpe = Bpe.from_str(model.decode("utf-8"))
    # Strings of special tokens are ordinary text.
    bpe.encode_special_tokens = True
    letters = _byte_letters()
    names = [bpe.id_to_token(i) or "" for i in range(bpe.get_vocab_size(with_added_tokens=True))]
    pieces = [bytes(letters[c] for c in n) if all(c in letters for c in n) else n.encode("utf-8") for n in names]
    return _tokenizer(lambda texts: [e.ids for e in bpe.encode_batch([" " + t for t in texts], add_special_tokens=False)], pieces)


@lru_cache(maxsize=4)
def piece_bpe(model: bytes) -> Tokenizer:
    from sentencepiece import SentencePieceProcessor

    spm = SentencePieceProcessor(model_proto=model)
    names = [spm.id_to_piece(i) for i in range(spm.get_piece_size())]
    if any("▁" in n.lstrip("▁") for n in names):
        raise ValueError("a piece holds a space behind another character, so texts cannot be cut at spaces")
    pieces = [bytes([int(n[3:5], 16)]) if spm.is_byte(i) else n.replace("▁", " ").encode("utf-8") for i, n in enumerate(names)]
    return _tokenizer(lambda texts: spm.encode(texts, num_threads=1), pieces)


def models(spark: SparkSession, byte_model: str, piece_model: str):
    """Both models' files as a broadcast; they are of fixed size."""

    def content(path: str) -> bytes:
        with open(path, "rb") as file:
            return file.read()

    return spark.sparkContext.broadcast((content(byte_model), content(piece_model)))


class Units:
    """Ids of the units seen so far, on both sides; forgotten when there are too many.

    A unit that begins and ends with a visible character is encoded together
    with others, spaces between: the tokens of such a text end where its units
    do. Which tokens are whose follows from their bytes, and a text that is not
    spelt by them is encoded unit by unit.
    """

    #: Units that are remembered, and that are encoded as one text.
    MOST, TOGETHER = 1 << 18, 512

    def __init__(self, a: Tokenizer, b: Tokenizer) -> None:
        self.sides = (a, b)
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = [np.zeros(0, np.int64) for _ in self.sides]
        self.n = [np.zeros(0, np.int64) for _ in self.sides]
        self.good = np.zeros(0, bool)

    def places(self, units: list[str]) -> np.ndarray:
        """The place of each of these distinct units, whose ids are then there."""
        if len(self.place) > self.MOST:
            self._forget()
        new = [u for u in units if u not in self.place]
        inner = [u for u in new if _VISIBLE.fullmatch(u)]
        new = inner + [u for u in new if not _VISIBLE.fullmatch(u)]
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
        good = np.ones(len(new), bool)
        for side, t in enumerate(self.sides):
            ids, n, spelt = _encode_units(t, new, len(inner), self.TOGETHER)
            self.ids[side], self.n[side] = np.concatenate([self.ids[side], ids]), np.concatenate([self.n[side], n])
            good &= spelt
        self.good = np.concatenate([self.good, good])
        return np.fromiter(map(self.place.__getitem__, units), np.int64, len(units))


def _encode_units(t: Tokenizer, units: list[str], inner: int, together: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all units, how many each has, and whether they spell it; the first ``inner`` units can stand in one text."""
    groups = [units[i : min(i + together, inner)] for i in range(0, inner, together)]
    ids, n, spelt = [], [], []

    def alone(some: list[str]) -> None:
        for u, own in zip(some, t.encode(some), strict=True):
            ids.append(np.array(own, np.int64))
            n.append([len(own)])
            spelt.append([b"".join(t.pieces[i] for i in own) == b" " + u.encode("utf-8")])

    for group, own in zip(groups, t.encode([" ".join(g) for g in groups]), strict=True):
        own = np.array(own, np.int64)
        wanted = [b" " + u.encode("utf-8") for u in group]
        end = np.cumsum([len(w) for w in wanted])
        last = np.searchsorted(np.cumsum(t.sizes[own]), end)
        if b"".join([t.pieces[i] for i in own]) == b"".join(wanted) and (np.cumsum(t.sizes[own])[last] == end).all():
            ids.append(own)
            n.append(np.diff(last + 1, prepend=0))
            spelt.append(np.ones(len(group), bool))
        else:
            alone(group)
    alone(units[inner:])
    return (np.concatenate(x) if x else np.zeros(0, kind) for x, kind in ((ids, np.int64), (n, np.int64), (spelt, bool)))


def align(texts: list[str | None], known: Units) -> Aligned:
    units = [_UNIT.split(t) if t else [] for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(u) for u in units])
    codes, distinct = pd.factorize(np.array([u for us in units for u in us], dtype=object))
    codes = known.places(list(distinct))[codes]
    wrong = np.zeros(len(texts), bool)
    for d in np.unique(owner[~known.good[codes]]):
        # Units of a text may each be wrong and yet right together.
        whole = b"".join(b" " + u.encode("utf-8") for u in units[d])
        for ids, n, t in zip(known.ids, known.n, known.sides, strict=True):
            at, own = np.cumsum(n) - n, codes[owner == d]
            spelt = b"".join(t.pieces[i] for c in own for i in ids[at[c] : at[c] + n[c]])
            wrong[d] |= spelt != whole
    codes, owner = codes[~wrong[owner]], owner[~wrong[owner]]
    ids_, doc, end, start = [], [], [], []
    for ids, n, t in zip(known.ids, known.n, known.sides, strict=True):
        take = n[codes]
        first = np.repeat((np.cumsum(n) - n)[codes] - (np.cumsum(take) - take), take)
        ids_.append(ids[first + np.arange(len(first))])
        doc.append(np.repeat(owner, take))
        size = t.sizes[ids_[-1]]
        end.append(np.cumsum(size))
        start.append(end[-1] - size)
    left, right = _overlaps(start, doc)
    return Aligned(tuple(ids_), tuple(doc), tuple(end), left, right, _groups(*end))


def _overlaps(start: list[np.ndarray], doc: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of an A and a B token that share a byte."""
    a, b = (pd.DataFrame({"at": s, "doc": d, "place": np.arange(len(s))}) for s, d in zip(start, doc, strict=True))
    over_a = pd.merge_asof(a, b, on="at", by="doc", suffixes=("", "_other"))["place_other"].to_numpy(np.int64)
    over_b = pd.merge_asof(b, a, on="at", by="doc", suffixes=("", "_other"))["place_other"].to_numpy(np.int64)
    # Tokens that start together find each other from both sides.
    later = start[0][over_b] < start[1]
    return np.concatenate([a["place"].to_numpy(), over_b[later]]), np.concatenate([over_a, b["place"].to_numpy()[later]])


def _groups(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token; one ends where tokens of both sides end."""
    cuts = np.intersect1d(end_a, end_b, assume_unique=True)
    return np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)


def _texts_of_groups(found: Aligned, n_docs: int, sizes: tuple[int, int]) -> list[str]:
    """Per text its groups as ``a1,a2|b1;a3|b2,b3``."""
    n = [len(x) for x in found.ids]
    order = np.argsort(np.concatenate([2 * found.group[0], 2 * found.group[1] + 1]), kind="stable")
    side = (order >= n[0]).astype(np.int64)
    group = np.concatenate(found.group)[order]
    ids, doc = np.concatenate(found.ids)[order], np.concatenate(found.doc)[order]
    # Behind a token: another of its side, the other side, or the next group.
    mark = np.where(np.append(group[1:] != group[:-1], True), 2, np.append(side[1:] != side[:-1], True))
    written = _written(max(sizes))[mark, ids]
    at = np.searchsorted(doc, np.arange(n_docs + 1))
    return ["".join(written[i:j])[:-1] for i, j in zip(at, at[1:], strict=False)]


@lru_cache(maxsize=2)
def _written(n: int) -> np.ndarray:
    return np.array([[f"{i}{mark}" for i in range(n)] for mark in ",|;"], dtype=object)


def _batches(parts: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """Rows in batches of so many characters; a longer text is a batch of its own."""
    for part in parts:
        size = part["text"].str.len().fillna(0).to_numpy(np.int64)
        of = (np.cumsum(size) - size) // most
        for k in np.unique(of):
            yield part[of == k].reset_index(drop=True)


def _figures(batch: pd.DataFrame, known: Units) -> tuple[pd.DataFrame, np.ndarray]:
    """A row per document, and the id pair of each of its links, document by document."""
    n, sizes = len(batch), tuple(len(t.pieces) for t in known.sides)
    found = align([t if isinstance(t, str) else None for t in batch["text"]], known)
    out = pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64")})
    out["n_a"], out["n_b"] = (np.bincount(d, minlength=n) for d in found.doc)
    # The last token of a group on side A ends it.
    last = np.append(found.group[0][1:] != found.group[0][:-1], True)[: len(found.group[0])]
    out["n_groups"] = np.bincount(found.doc[0][last], minlength=n)
    of = found.doc[0][found.left]
    out["n_links"] = np.bincount(of, minlength=n)
    groups = _texts_of_groups(found, n, sizes)
    out["groups_sha256"] = [hashlib.sha256(g.encode("ascii")).hexdigest() if g else "" for g in groups]
    pair = found.ids[0][found.left] * sizes[1] + found.ids[1][found.right]
    return out, pair[np.argsort(of, kind="stable")]


def encoded(documents: DataFrame, byte_model: str, piece_model: str) -> DataFrame:
    """Figures and links of every document, and of every block one row with its distinct pairs and their counts.

    A pair is ``a * (number of B's ids) + b``; links name a pair of the block
    by its place there.
    """
    both = models(documents.sparkSession, byte_model, piece_model)

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Units(byte_bpe(both.value[0]), piece_bpe(both.value[1]))
        block, size, held = TaskContext.get().partitionId() << 32, 0, []
        for batch in _batches(parts, BATCH):
            held.append(_figures(batch, known))
            size += int(batch["text"].str.len().sum())
            if size >= BLOCK:
                yield from _block(block, held)
                block, size, held = block + 1, 0, []
        yield from _block(block, held)

    columns = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(columns.mapInPandas(rows, _ENCODED), "encoded")


def _block(block: int, held: list[tuple[pd.DataFrame, np.ndarray]]) -> Iterator[pd.DataFrame]:
    if not held:
        return
    pairs, place, counts = np.unique(np.concatenate([p for _, p in held]), return_inverse=True, return_counts=True)
    # Frequent pairs have small places, which take less room.
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    place, start = rank[place], 0
    for out, _ in held:
        n = out["n_links"].to_numpy()
        at = start + np.concatenate([[0], np.cumsum(n)])
        start = at[-1]
        links = [packed_numbers(place[i:j]) for i, j in zip(at, at[1:], strict=False)]
        yield out.assign(block=block, links=links, pairs=None, counts=None)
    empty = {"doc_id": pd.array([None], "Int64"), "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": "", "block": block, "links": None}
    yield pd.DataFrame(empty | {"pairs": [pairs[order]], "counts": [counts[order]]})


def pair_entries(rows: DataFrame) -> DataFrame:
    """``block, place, pair, n``: the distinct pairs of every block."""
    each = rows.filter("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "of"))
    return each.select("block", "place", F.col("of.pairs").alias("pair"), F.col("of.counts").alias("n"))


def pair_counts(entries: DataFrame, n_b: int) -> DataFrame:
    """``pair, total, best``: links of the whole corpus, and whether no other A id has more with that B id."""
    totals = stored(entries.groupBy("pair").agg(F.sum("n").alias("total")), "totals")
    b = (F.col("pair") % n_b).alias("b")
    most = totals.groupBy(b).agg(F.max("total").alias("most"))
    # At most a row for each id of B.
    return totals.select("*", b).join(F.broadcast(most), "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def _scored(rows: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
    sums = sums.sort_values("place")
    total, best = sums["total"].to_numpy(np.int64), sums["best"].to_numpy(np.int64)
    n = rows["n_links"].to_numpy(np.int64)
    links = np.concatenate([unpacked_numbers(x) for x in rows["links"]])
    of = np.repeat(np.arange(len(rows)), n)
    out = rows[["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]].copy()
    out["doc_id"] = out["doc_id"].astype("Int64")
    out["n_best"] = np.bincount(of[best[links] == 1], minlength=len(rows))
    # Exact: sums of differences of a running total in 64 bits.
    run = np.concatenate([[0], np.cumsum(total[links])])
    at = np.concatenate([[0], np.cumsum(n)])
    out["count_sum"] = run[at[1:]] - run[at[:-1]]
    return out


def alignment_figures(documents: DataFrame, byte_model: str = f"{TOKENIZERS}/{BYTE_BPE}", piece_model: str = f"{TOKENIZERS}/{PIECE_BPE}") -> DataFrame:
    """One row per document: numbers of tokens, groups and links, and how frequent its linked id pairs are in the corpus."""
    rows = encoded(documents, byte_model, piece_model)
    entries = pair_entries(rows)
    with open(piece_model, "rb") as file:
        n_b = len(piece_bpe(file.read()).pieces)
    told = pair_counts(entries, n_b)
    back = entries.select("block", "place", "pair").join(told.hint("merge"), "pair").select(F.col("block").alias("to"), "place", "total", "best")
    own = rows.filter("pairs is null").drop("pairs", "counts")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return own.groupBy("block").cogroup(back.groupBy("to")).applyInPandas(_scored, schema)


def aligned_groups(documents: DataFrame, byte_model: str = f"{TOKENIZERS}/{BYTE_BPE}", piece_model: str = f"{TOKENIZERS}/{PIECE_BPE}") -> DataFrame:
    """``doc_id, group, start, end, a_ids, b_ids``: a row per group, offsets in bytes of the text behind its space."""
    both = models(documents.sparkSession, byte_model, piece_model)

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Units(byte_bpe(both.value[0]), piece_bpe(both.value[1]))
        for batch in _batches(parts, BATCH):
            found = align([t if isinstance(t, str) else None for t in batch["text"]], known)
            if not len(found.ids[0]):
                continue
            cuts = [np.nonzero(np.append(g[1:] != g[:-1], True))[0] + 1 for g in found.group]
            end = found.end[0][cuts[0] - 1]
            doc = found.doc[0][cuts[0] - 1]
            first = np.concatenate([[True], doc[1:] != doc[:-1]])
            start = np.concatenate([[0], end[:-1]])
            base = start[first][np.cumsum(first) - 1]
            number = np.arange(len(end)) - np.nonzero(first)[0][np.cumsum(first) - 1]
            ids = [np.split(i, c[:-1]) for i, c in zip(found.ids, cuts, strict=True)]
            ids_of = batch["doc_id"].astype("Int64").to_numpy()
            yield pd.DataFrame({"doc_id": pd.array(ids_of[doc], "Int64"), "group": number, "start": start - base, "end": end - base, "a_ids": ids[0], "b_ids": ids[1]})

    columns = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.mapInPandas(rows, "doc_id long, group long, start long, end long, a_ids array<long>, b_ids array<long>")
