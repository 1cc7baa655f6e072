"""Benchmark decontamination by the q-gram lemma and banded alignment.

Text and items are compared in lower case with white space runs as one blank.
Items are looked for in pieces of 128 characters that begin every 64 (a shorter
item is one piece). A piece of m characters allows e = 8 % of m edits. A place
in a text that is within e edits shares at least (grams looked up) - q * e of
the piece's q-grams with it, all on diagonals at most e apart. So the shared
q-grams are counted in bands of diagonals that overlap by half, bands that
reach the bound are places to look at, and a banded alignment counts their
edits.

Pieces of one item that are found in its order, and as far apart as they are in
the item, are one region; ``share`` tells how much of the item its pieces are.
So 191 characters in a row of an item are found wherever they stand, and a
shorter item if all of it is there.

The lemma holds for any subset of an item's grams. The most frequent ones are
left out, as far as the bound allows, so common phrases cost little.

The benchmark is taken in blocks of bounded size; each is broadcast and read
against all texts in whole.

Defined results: null texts and items match nothing, nor do items of fewer
than q characters. Several items may claim one region. Copies behind each other are
a region each; places of one piece that overlap are one, that with the fewest
edits. ``edits`` counts those between a region and all of the item from its
first piece to its last. Repeated rows of documents are found each. Offsets
count characters of the text as given.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalframe.llm.shared import packed, unpacked

Q = 8
EDIT_RATE = 0.08
#: Characters of a piece, and from one piece to the next.
PIECE = 128
STRIDE = 64
#: Characters of a block; more than the edits that a piece allows.
STEP = 32
#: Diagonals of a band, which is three cells of blocks.
BAND = 4 * STEP - 1
#: Characters of the benchmark in one block, about.
BLOCK_CHARS = 2 << 20
#: Characters of texts that are worked on at a time; a longer text is a batch of its own.
SLAB = 1 << 20
#: Shared grams that are counted at a time.
ENTRIES = 1 << 20

_REGION = "array<struct<item_id:long,start:long,end:long,edits:int,share:double>>"
_SPACES = np.array([9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], np.uint32)
_FACTOR = 0x9E3779B97F4A7C15


def folded(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case, blanks made one, and where each stands in the text."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    chars = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    # A table for the planes in use would be large; all spaces are below 0x3001.
    space = _IS_SPACE[np.minimum(chars, 0x3001)]
    again = np.zeros(len(chars), bool)
    again[1:] = space[1:] & space[:-1]
    at = np.nonzero(~again)[0]
    return np.where(space, np.uint32(32), chars)[at], at


_IS_SPACE = np.zeros(0x3002, bool)
_IS_SPACE[_SPACES] = True


def gram_hashes(chars: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the Q characters from each position on."""
    out = np.zeros(max(0, len(chars) - Q + 1), np.uint64)
    done, part = 0, chars.astype(np.uint64)
    # Hashes of 1, 2, 4, 8 characters, put together to Q.
    width, factor = 1, _FACTOR
    while width <= Q:
        if Q & width:
            out *= np.uint64(pow(_FACTOR, width, 1 << 64))
            out += part[done : done + len(out)]
            done += width
        if 2 * width <= Q:
            part = part[:-width] * np.uint64(factor) + part[width:]
        factor = factor * factor % (1 << 64)
        width *= 2
    out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class Index:
    """Pieces of benchmark items; the blocks of them in which each q-gram stands, in the order of its hash."""

    item: list
    #: The whole item of each piece, and where it begins there.
    whole: list[np.ndarray]
    offset: list[int]
    pieces: list[np.ndarray]
    edits: np.ndarray
    #: How many grams a band must share with the piece.
    least: np.ndarray
    grams: np.ndarray
    begin: np.ndarray
    of: np.ndarray
    at: np.ndarray
    seen: np.ndarray
    bits: int


def build_index(items: list[tuple[int | None, str]], edit_rate: float = EDIT_RATE) -> Index:
    item, whole, offset, pieces = [], [], [], []
    for name, text in items:
        chars = folded(text.strip())[0]
        last = max(0, len(chars) - PIECE)
        for begin in [*range(0, last, STRIDE), last] if len(chars) >= Q else ():
            item.append(name)
            whole.append(chars)
            offset.append(begin)
            pieces.append(chars[begin : begin + PIECE])
    hashes = [gram_hashes(p) for p in pieces]
    size = np.array([len(h) for h in hashes], np.int64)
    # With so many edits at least one gram is left to be shared.
    edits = np.minimum((edit_rate * (size + Q - 1)).astype(np.int64), (size - 1) // Q)
    every = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    _, back, often = np.unique(every, return_inverse=True, return_counts=True)
    of = np.repeat(np.arange(len(pieces)), size)
    at = np.concatenate([np.arange(n) for n in size]) if hashes else np.empty(0, np.int64)
    # Of each piece the rarest grams, half as many again as the bound leaves over.
    order = np.lexsort((at, often[back], of))
    rank = np.arange(len(order)) - np.repeat(np.cumsum(size) - size, size)
    wanted = Q * edits + np.maximum((size - Q * edits + 1) // 2, 1)
    chosen = order[rank < wanted[of[order]]]
    # A gram that repeats within a block of its piece is listed once.
    listed = np.unique(np.stack([back[chosen], of[chosen], at[chosen] // STEP]), axis=1)
    names = np.unique(every)
    grams, begin = np.unique(names[listed[0]], return_index=True)
    bits = max(20, int(16 * len(grams)).bit_length())
    seen = np.zeros(1 << bits, bool)
    seen[grams >> np.uint64(64 - bits)] = True
    return Index(item, whole, offset, pieces, edits, wanted - Q * edits, grams, np.append(begin, listed.shape[1]), listed[1], listed[2], seen, bits)


def candidate_bands(index: Index, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces and first diagonals of the bands that share enough grams, each band BAND wide.

    Text and pieces are cut into blocks of STEP characters; block differences
    are the cells that grams are counted in. Diagonals at most STEP apart lie
    within three cells in a row. A gram counts once for each of its places in
    the text and each block of the piece, so repeats within a block are cheap.
    """
    hashed = gram_hashes(chars)
    where = np.nonzero(index.seen[hashed >> np.uint64(64 - index.bits)])[0]
    place = np.searchsorted(index.grams, hashed[where])
    place[place == len(index.grams)] = 0
    real = index.grams[place] == hashed[where]
    blocks = len(chars) // STEP + 1
    met, times = np.unique(place[real] * blocks + where[real] // STEP, return_counts=True)
    place, block = met // blocks, met % blocks
    n = index.begin[place + 1] - index.begin[place]
    # Negative differences occur where a text begins inside an item.
    before = PIECE // STEP + 1
    cells = blocks + 2 * before

    def entries() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Key of piece and cell, weight and piece, so many at a time as fit."""
        cuts = np.searchsorted(np.cumsum(n), np.arange(ENTRIES, n.sum() + ENTRIES, ENTRIES), side="right")
        for i, j in zip([0, *cuts], [*cuts, len(n)], strict=True):
            m = n[i:j]
            entry = np.repeat(index.begin[place[i:j]] - np.cumsum(m) + m, m) + np.arange(m.sum())
            piece = index.of[entry]
            yield piece * cells + np.repeat(block[i:j], m) - index.at[entry] + before, np.repeat(times[i:j], m), piece

    # A rough count first: cells that share a slot only make it larger.
    slot = lambda k: ((k.astype(np.uint64) * np.uint64(_FACTOR)) >> np.uint64(44)).astype(np.int64)
    rough = np.zeros(1 << 20)
    for key, weight, _ in entries():
        rough += np.bincount(slot(key), weight, minlength=1 << 20)
    found, count = np.empty(0, np.int64), np.empty(0)
    for key, weight, piece in entries():
        near = sum(rough[slot(key + k)] for k in range(-2, 3)) >= index.least[piece]
        found, back = np.unique(np.concatenate([found, key[near]]), return_inverse=True)
        count = np.bincount(back, np.concatenate([count, weight[near]]), minlength=len(found))
    # A band begins in a cell with a count; one that begins in an empty cell holds no more.
    both = count.copy()
    for k in (1, 2):
        ahead = np.searchsorted(found, found + k)
        ahead[ahead == len(found)] = 0
        both += np.where(found[ahead] == found + k, count[ahead], 0) if len(found) else 0
    good = both >= index.least[found // cells]
    return found[good] // cells, (found[good] % cells - before) * STEP - STEP + 1


def align(patterns: list[np.ndarray], texts: list[np.ndarray], edits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of each pattern anywhere in its text, and where the best place ends (first such end).

    All pairs go through the rows of their matrices together. A text is longer
    than its pattern by the width of the band at most.
    """
    width = max(len(t) - len(p) for p, t in zip(patterns, texts, strict=True)) + int(edits.max()) + 1
    rows = max(map(len, patterns))
    # Beyond the end of a text or pattern no character matches.
    t = np.full((len(texts), rows + width + 1), 0xFFFFFFFF, np.uint32)
    p = np.full((len(texts), rows), 0xFFFFFFFE, np.uint32)
    for i, (x, y) in enumerate(zip(patterns, texts, strict=True)):
        p[i, : len(x)], t[i, : len(y)] = x, y
    lengths = np.array([len(x) for x in patterns])
    ends = np.array([len(y) for y in texts])
    # Diagonals from -edits on: the best place may begin before the text does.
    low = int(edits.max())
    slope = np.arange(width + low, dtype=np.int32)
    far = np.int32(1 << 20)
    cost = np.zeros((len(texts), width + low), np.int32)
    cost[:, :low] = far
    best, end = np.full(len(texts), far), np.zeros(len(texts), np.int64)
    padded = np.concatenate([np.full((len(texts), low), 0xFFFFFFFF, np.uint32), t], axis=1)
    for i in range(rows):
        column = i + slope - low + 1
        diagonal = cost + (padded[:, i : i + width + low] != p[:, i : i + 1])
        above = np.concatenate([cost[:, 1:], np.full((len(texts), 1), far)], axis=1) + 1
        cost = np.minimum(diagonal, above)
        cost[:, column < 0] = far
        # Column 0: all characters of the pattern so far are left out.
        cost[:, column == 0] = i + 1
        cost = np.minimum.accumulate(cost - slope, axis=1) + slope
        done = np.nonzero(lengths == i + 1)[0]
        if len(done):
            last = np.where(column[None, :] <= ends[done, None], cost[done], far)
            end[done] = column[last.argmin(1)]
            best[done] = last.min(1)
    return best, end


#: A place of a piece: first and last character in the folded text, edits, piece.
Hit = tuple[int, int, int, int]


def find_regions(index: Index, texts: list[str | None]) -> list[list[dict]]:
    """For each text the regions that benchmark items stand in, with offsets in that text."""
    out: list[list[dict]] = [[] for _ in texts]
    part: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        if text and index.pieces:
            part.append(i)
            size += len(text)
        if part and (size >= SLAB or i == len(texts) - 1):
            fold = [folded(texts[k]) for k in part]
            for k, (chars, at), hits in zip(part, fold, _search(index, [f[0] for f in fold]), strict=True):
                out[k] = _regions(index, hits, chars, at)
            part, size = [], 0
    return out


def _search(index: Index, folds: list[np.ndarray]) -> list[list[Hit]]:
    """For each text all places of pieces; overlapping bands find a place twice."""
    hits: list[list[Hit]] = [[] for _ in folds]
    # A character that no item holds keeps grams from reaching over two texts.
    gap = np.full(1, 0x10FFFF, np.uint32)
    chars = np.concatenate([x for f in folds for x in (f, gap)])
    begins = np.cumsum([0, *[len(f) + 1 for f in folds]])
    if len(chars) < Q:
        return hits
    todo = []
    # Bands of a piece come in order; nothing that overlaps an exact copy of it is kept beside that.
    copied: dict[tuple[int, int], int] = {}
    for piece, diagonal in zip(*candidate_bands(index, chars), strict=True):
        pattern, slack = index.pieces[piece], index.edits[piece]
        first, last = diagonal - slack, diagonal + BAND + slack + len(pattern)
        for k in range(max(0, np.searchsorted(begins, first, side="right") - 1), len(folds)):
            if begins[k] >= last:
                break
            a, b = max(first, begins[k]), min(last, begins[k + 1] - 1)
            stretch = (piece, k, max(a - begins[k], copied.get((piece, k), 0)), b - begins[k])
            if _fits(index, stretch):
                known = len(hits[k])
                todo += _inexact(index, folds[k], stretch, hits[k])
                if len(hits[k]) > known:
                    copied[piece, k] = hits[k][-1][1]
    while todo:
        # Next to a place that was found there may be another.
        later = []
        for begin in range(0, len(todo), 64):
            group = todo[begin : begin + 64]
            patterns, slack = [index.pieces[g[0]] for g in group], index.edits[[g[0] for g in group]]
            stretches = [folds[k][a:b] for _, k, a, b in group]
            cost, end = align(patterns, stretches, slack)
            held = np.nonzero(cost <= slack)[0]
            if not len(held):
                continue
            # Backwards from where it ends, the same alignment tells where it begins.
            _, back = align([patterns[i][::-1] for i in held], [stretches[i][: end[i]][::-1][: len(patterns[i]) + slack[i]] for i in held], slack[held])
            for i, length in zip(held, back, strict=True):
                piece, k, a, b = group[i]
                hits[k].append((int(a + end[i] - length), int(a + end[i]), int(cost[i]), piece))
                later += [s for s in ((piece, k, a, a + end[i] - length), (piece, k, a + end[i], b)) if _fits(index, s)]
        todo = later
    return hits


def _fits(index: Index, stretch: tuple) -> bool:
    piece, _, a, b = stretch
    return b - a >= max(1, len(index.pieces[piece]) - index.edits[piece])


def _inexact(index: Index, chars: np.ndarray, stretch: tuple, hits: list[Hit]) -> list[tuple]:
    """Notes the exact copies of a piece, which need no matrix, and returns the stretches between them."""
    piece, k, a, b = stretch
    pattern, region = index.pieces[piece].tobytes(), chars[a:b].tobytes()
    left, at = [], region.find(pattern)
    done = 0
    while at >= 0:
        if at % 4:
            at = region.find(pattern, at + 1)
            continue
        hits.append((int(a + at // 4), int(a + (at + len(pattern)) // 4), 0, piece))
        left.append((piece, k, a + done, a + at // 4))
        done = (at + len(pattern)) // 4
        at = region.find(pattern, 4 * done)
    return [s for s in (*left, (piece, k, a + done, b)) if _fits(index, s)]


def _regions(index: Index, hits: list[Hit], chars: np.ndarray, at: np.ndarray) -> list[dict]:
    """Places put together: one of those that overlap for each piece, then chains of pieces."""
    taken: dict[int, list[tuple[int, int]]] = {}
    places = []
    for start, end, edits, piece in sorted(set(hits), key=lambda h: (h[2], h[0], -h[1], h[3])):
        if _free(taken.setdefault(piece, []), start, end):
            places.append((index.item[piece], start, index.offset[piece], end, edits, piece))
    found: list[dict] = []
    chains: dict[int | None, list[dict]] = {}
    for item, start, offset, end, edits, piece in sorted(places, key=lambda p: (p[0] is None, p[0] or 0, *p[1:])):
        open_ = chains[item] = [c for c in chains.get(item, ()) if start - c["end"] <= PIECE]
        width = len(index.pieces[piece])
        for c in open_:
            if offset > c["offset"] and abs((start - c["last"]) - (offset - c["offset"])) <= STEP:
                c["covered"] += min(width, offset + width - c["upto"])
                c["drift"] = max(c["drift"], abs((start - c["start"]) - (offset - c["first"])))
                c.update(end=max(c["end"], end), last=start, offset=offset, upto=offset + width, edits=None)
                break
        else:
            c = {"item": item, "start": start, "end": end, "last": start, "first": offset, "offset": offset, "upto": offset + width, "covered": width, "edits": edits, "drift": 0, "whole": index.whole[piece]}
            open_.append(c)
            found.append(c)
    # Chains of one item whose middles overlap are one, that with the most pieces: a periodic text has many.
    middles: dict[int | None, list[tuple[int, int]]] = {}
    quarter = lambda c: (c["end"] - c["start"]) // 4
    found.sort(key=lambda c: (-c["covered"], c["start"]))
    found = [c for c in found if _free(middles.setdefault(c["item"], []), c["start"] + quarter(c), c["end"] - quarter(c))]
    for c in found:
        if c["edits"] is None:
            c["start"], c["end"], c["edits"] = _aligned(c["whole"][c["first"] : c["upto"]], chars, c["start"], c["end"], c["drift"])
    return [
        {"item_id": c["item"], "start": int(at[c["start"]]), "end": int(at[c["end"] - 1]) + 1, "edits": c["edits"], "share": c["covered"] / len(c["whole"])}
        for c in sorted(found, key=lambda c: (c["start"], c["end"]))
    ]


def _free(held: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether nothing held overlaps; if so it is held, too."""
    i = bisect_left(held, (start, end))
    free = (i == 0 or held[i - 1][1] <= start) and (i == len(held) or held[i][0] >= end)
    if free:
        held.insert(i, (start, end))
    return free


def _aligned(pattern: np.ndarray, chars: np.ndarray, start: int, end: int, drift: int) -> tuple[int, int, int]:
    """Where a chain of pieces begins and ends, and its edits, in a band that holds the diagonals of all of them."""
    if np.array_equal(pattern, chars[start:end]):
        return start, end, 0
    slack = np.array([drift + 2 * STEP])
    cost, stop = align([pattern], [chars[start:end]], slack)
    _, length = align([pattern[::-1]], [chars[start : start + stop[0]][::-1]], slack)
    return int(start + stop[0] - length[0]), int(start + stop[0]), int(cost[0])


def benchmark_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[Index]:
    """Indexes of the benchmark's blocks, each of bounded size."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        yield build_index(sorted(((r["item_id"], r["text"]) for r in rows), key=repr))


def _finder(documents: DataFrame, index: Index):
    shared = documents.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf(_REGION)
    def regions(texts: pd.Series) -> pd.Series:
        return pd.Series(find_regions(shared.value, [t if isinstance(t, str) else None for t in texts]), dtype=object)

    return regions


def leaked_regions(documents: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, item_id, start, end, edits, share``: every region of a document that a benchmark item stands in."""
    rows = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    out = None
    for index in benchmark_blocks(benchmark):
        found = rows.select("doc_id", F.explode(_finder(rows, index)("text")).alias("r"))
        found = found.select("doc_id", "r.item_id", "r.start", "r.end", "r.edits", "r.share")
        out = found if out is None else out.unionByName(found)
    return out


def decontaminated(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents without any such region, unchanged."""
    rows = documents.select(packed(documents).alias("_row"))

    def clean(index: Index) -> Column:
        return F.size(_finder(documents, index)(F.col("_row")[text])) == 0

    for index in benchmark_blocks(benchmark):
        rows = rows.filter(clean(index))
    return unpacked(rows)
