"""Exact deduplication against a minimal perfect hash over the digests of earlier texts.

A text's identity is the SHA-256 of its UTF-8 bytes after every run of ASCII
white space has become one space. The index holds the distinct digests of the
history, dealt over buckets by their hash. A bucket has a minimal perfect hash
of its own: levels of bits, in which a digest owns the first bit that no other
digest of its level shares, and the number of bits set before it is its slot.
A slot holds the full digest, the locator of the row that stays and the number
of copies. A lookup compares all 32 bytes, so a digest that is no member, which
the hash sends to some slot as well, never counts as a repeat. Nonmembers are
grouped among themselves.

Copies are reduced to one row per digest and task before any shuffle, so a text
that a third of all rows share costs no more than another; the one join that
carries every row has each digest once on its other side, and adaptive
execution splits its hot digest. Index and batch are dealt over as many buckets
as keep one at about ``KEYS`` digests, whatever their size.

Defined results: a null text counts as empty, and empty texts are equal. Among
equal texts of a batch the row with the smallest id stays, one without id only
if none has one, and of rows that repeat the id the first as read; texts of the
history stay before all of a batch. An empty table gives no rows. Extra columns
are kept by ``without_repeats`` under any name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalframe.llm.shared import col, packed, stored, unpacked

#: Digests of a bucket, about.
KEYS = 1 << 14

_ENTRY = "bucket long, digest binary, keep_id long, keep_row long, n long"
_INDEX = "bucket long, sizes array<long>, bits binary, digests binary, keep_ids array<long>, keep_rows array<long>, copies array<long>"
_GAMMA = 2


def normalized(text: Column) -> Column:
    """Every run of ASCII white space as one space; null is empty. A lone space matches nothing and costs nothing."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def digested(documents: DataFrame, *columns: Column) -> DataFrame:
    """``doc_id, row, digest`` and the columns given; ``row`` is one number for each row, fixed by writing it."""
    digest = F.unhex(F.sha2(normalized(F.col("text")), 256))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), digest.alias("digest"), *columns)
    return stored(rows, "digests")


def winners(rows: DataFrame) -> DataFrame:
    """Per digest the locator of the row that stays and the number of copies."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row"))
    found = rows.groupBy("digest").agg(first.alias("first"), F.count("*").alias("n"))
    return stored(found.select("digest", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"), "n"), "winners")


def bucketed(entries: DataFrame, buckets: int) -> DataFrame:
    return entries.select(F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket"), "digest", "keep_id", "keep_row", "n")


def buckets_for(n: int) -> int:
    return max(1, -(-n // KEYS))


def _words(digests: bytes) -> np.ndarray:
    return np.frombuffer(digests, "<u8").reshape(-1, 4)


def _place(words: np.ndarray, level: int, size: int) -> np.ndarray:
    x = words[:, level % 4] + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return ((x ^ x >> np.uint64(31)) % np.uint64(size)).astype(np.int64)


def perfect_hash(words: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Sizes of the levels and all their bits, for distinct digests of four words each."""
    sizes, bits, left = [], [], words
    while len(left):
        size = max(64, _GAMMA * len(left))
        at = _place(left, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        left = left[~alone[at]]
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool)


def slots(words: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The slot of each digest; for one that is no member any slot, or -1."""
    rank = np.cumsum(bits) - 1
    out, left, base = np.full(len(words), -1, np.int64), np.arange(len(words)), 0
    for level, size in enumerate(sizes):
        at = base + _place(words[left], level, size)
        hit = bits[at]
        out[left[hit]] = rank[at[hit]]
        left, base = left[~hit], base + size
    return out


def _index_of(entries: pd.DataFrame) -> pd.DataFrame:
    words = _words(b"".join(entries["digest"]))
    sizes, bits = perfect_hash(words)
    order = np.argsort(slots(words, sizes, bits))
    placed = entries.iloc[order]
    ids = [None if pd.isna(x) else int(x) for x in placed["keep_id"]]
    row = [int(entries["bucket"].iat[0]), sizes, np.packbits(bits).tobytes(), b"".join(placed["digest"]), ids, list(placed["keep_row"]), list(placed["n"])]
    return pd.DataFrame([row], columns=["bucket", "sizes", "bits", "digests", "keep_ids", "keep_rows", "copies"])


def build_index(entries: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket: its perfect hash, and the digests, locators and numbers of copies by slot.

    ``entries`` has each digest once, as ``winners`` gives them.
    """
    return stored(bucketed(entries, buckets).groupBy("bucket").applyInPandas(_index_of, _INDEX), "index")


def index_entries(index: DataFrame) -> DataFrame:
    """The digests of an index with their locators, to build it anew with more buckets or more digests."""
    one = F.posexplode(F.arrays_zip("keep_ids", "keep_rows", "copies")).alias("slot", "of")
    digest = F.substr(F.col("digests"), 32 * F.col("slot") + 1, F.lit(32))
    each = index.select("digests", one)
    return each.select(digest.alias("digest"), F.col("of.keep_ids").alias("keep_id"), F.col("of.keep_rows").alias("keep_row"), F.col("of.copies").alias("n"))


def _looked_up(index: pd.DataFrame, batch: pd.DataFrame) -> pd.DataFrame:
    out = batch[["digest", "keep_id", "keep_row", "n"]].assign(earlier=np.int64(0), member=False)
    if not len(index) or not len(batch):
        return out
    own = index.iloc[0]
    held, words = _words(own["digests"]), _words(b"".join(batch["digest"]))
    sizes = [int(s) for s in own["sizes"]]
    slot = slots(words, sizes, np.unpackbits(np.frombuffer(own["bits"], np.uint8), count=sum(sizes)).astype(bool))
    member = (slot >= 0) & (held[slot] == words).all(1)
    ids, rows, copies = (own[c] for c in ("keep_ids", "keep_rows", "copies"))
    out["keep_id"] = pd.array([ids[s] if m else None if pd.isna(i) else int(i) for s, m, i in zip(slot, member, batch["keep_id"], strict=True)], "Int64")
    out["keep_row"] = np.where(member, np.asarray(rows, np.int64)[slot], batch["keep_row"])
    out["earlier"], out["member"] = np.where(member, np.asarray(copies, np.int64)[slot], 0), member
    return out


def look_up(index: DataFrame, batch: DataFrame, buckets: int) -> DataFrame:
    """``digest, keep_id, keep_row, n, earlier, member`` for every digest of ``batch``.

    For a member the locator is the one in its slot and ``earlier`` the copies
    counted there; a nonmember keeps its own.
    """
    pairs = index.groupBy("bucket").cogroup(bucketed(batch, buckets).groupBy("bucket"))
    return stored(pairs.applyInPandas(_looked_up, "digest binary, keep_id long, keep_row long, n long, earlier long, member boolean"), "looked-up")


def grouped(documents: DataFrame, before: Column) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row.

    Rows for which ``before`` holds are the history, whose digests make the
    index; all others are looked up in it.
    """
    rows = digested(documents, F.coalesce(before, F.lit(False)).alias("before"))
    history, batch = winners(rows.filter("before")), winners(rows.filter("not before"))
    buckets = buckets_for(max(history.count(), batch.count()))
    found = look_up(build_index(history, buckets), batch, buckets)
    # A digest is a member, or it stands in one of the two tables only.
    again = found.filter("member").groupBy("digest").agg(F.sum("n").alias("more"))
    old = history.join(again.hint("merge"), "digest", "left").withColumn("size", F.col("n") + F.coalesce("more", F.lit(0)))
    new = found.filter("not member").withColumn("size", F.col("n"))
    columns = ["digest", "keep_id", "keep_row", "size"]
    groups = stored(old.select(*columns).unionByName(new.select(*columns)), "groups")
    told = rows.join(groups.hint("merge"), "digest")
    return told.select(
        "doc_id", "keep_id", F.col("size").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def without_repeats(documents: DataFrame, index: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows that stay, with all their columns, and the index that now holds their digests too.

    ``index`` comes from an earlier call and stands for all texts seen so far.
    """
    row = packed(documents)
    rows = digested(documents.select(col("doc_id").alias("doc_id"), col("text").alias("text"), row.alias("_row")), F.col("_row"))
    batch = winners(rows.drop("_row"))
    held = winners(rows.drop("_row").limit(0)) if index is None else index_entries(index)
    buckets = buckets_for(max(held.count(), batch.count()))
    found = look_up(build_index(held, buckets), batch, buckets)
    stay = found.filter("not member").select("digest", "keep_row")
    # A digest holds one row that stays, so joined on the row's number no key is hot.
    kept = rows.select("row", "_row").join(stay.select(F.col("keep_row").alias("row")).hint("merge"), "row")
    columns = ["digest", "keep_id", "keep_row", "n"]
    added = found.filter("member").groupBy("digest").agg(F.sum("n").alias("more"))
    old = held.join(added.hint("merge"), "digest", "left").withColumn("n", F.col("n") + F.coalesce("more", F.lit(0)))
    every = old.select(*columns).unionByName(found.filter("not member").select(*columns))
    return unpacked(kept.select("_row")), build_index(stored(every, "entries"), buckets_for(held.count() + batch.count()))
