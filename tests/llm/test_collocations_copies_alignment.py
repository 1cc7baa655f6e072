"""Phrase mining, exact deduplication and token alignment: against brute force, and odd inputs."""

import bisect
import hashlib
import os
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fiscalframe.llm import alignment, catalog, exact_dedup, phrases

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string"
CLASHING = ("digest", "row", "bucket", "n", "keep_id", "before", "block", "pairs", "links", "words", "counts", "tokens", "f", "score", "_row")
LONG = " ".join(f"wort{i % 977}" for i in range(60_000))
ODD = [
    (1, "a  b\tc", "en"),
    (1, "a  b\tc", "en"),
    (2, "a b\n c", None),
    (3, None, "en"),
    (4, "", None),
    (5, " \t\n ", "de"),
    (6, LONG, "de"),
    (None, "a b c", "en"),
    (None, "alone", "fr"),
    (None, "alone", "fr"),
    (None, None, None),
    (7, "x" * 300_000, "de"),
    (8, "naïve ÉTÉ \x00 ＡＢ▁x <s> <|endoftext|> <0x41>", "fr"),
]


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame(ODD, DOCS)
    return plain.select("*", *[F.lit("mine").alias(c) for c in CLASHING])


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


# --- 11 ----------------------------------------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_collocations(documents, least, wanted):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in documents:
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang or "und"] += len(w)
            for m in range(1, 5):
                f[lang or "und"].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    rows = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if a >= least}
        longest = Counter()
        for p, a in often.items():
            if len(p) > 2:
                for inside in (p[1:], p[:-1]):
                    longest[inside] = max(longest[inside], a)
        found = []
        for p, a in often.items():
            if len(p) > 1 and 100 * longest[p] < 80 * a:
                score, k = min((2_000_000 * a // (often[p[:k]] + often[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), often[p[:k]], often[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:wanted], 1):  # noqa: E741
            rows.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(rows)


def collocations(df, wanted):
    return sorted(tuple(r) for r in phrases.collocations(df, wanted).collect())


@pytest.fixture
def rare_is_enough(monkeypatch):
    monkeypatch.setattr(phrases, "LEAST", 3)


@pytest.mark.parametrize("wanted", [5, 60])
def test_collocations_equal_brute_force_in_every_round(spark, rare_is_enough, monkeypatch, wanted):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    documents = []
    for i in range(300):
        picked = [words[int(40 * rng.random() ** 3)] for _ in range(60)]
        if i % 3 == 0:
            picked[10:10] = ["same", "four", "rare", "words", "here"]
        marks = [rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!"]) for _ in picked]
        documents.append((i, "".join(w + m for w, m in zip(picked, marks, strict=True)), rng.choice(["en", "en", "de", None])))
    df = spark.createDataFrame(documents, DOCS)
    expected = brute_collocations(documents, 3, wanted)
    assert {r[0] for r in expected} == {"en", "de", "und"}
    assert collocations(df.repartition(3), wanted) == expected
    # The first thresholds are never right for so few words; any other schedule gives the same.
    monkeypatch.setattr(phrases, "THRESHOLDS", (900_000, 500_000, 300_000, 0))
    monkeypatch.setattr(phrases, "BLOCK", 2000)
    monkeypatch.setattr(phrases, "BITS", 7)
    assert collocations(df.repartition(2), wanted) == expected


def test_collocations_of_odd_inputs(spark, docs, nothing, rare_is_enough):
    assert collocations(nothing, 10) == []
    assert collocations(docs, 2000) == brute_collocations(ODD, 3, 2000)
    bare = spark.createDataFrame([(1, None, "en"), (2, "...", "en"), (3, " ", None)], DOCS)
    assert collocations(bare, 10) == []


def test_ties_at_the_last_place_go_by_bytes(spark, rare_is_enough):
    pairs = ["é f", "z y", "a b", "￿ x", "\U0001f600 w", "c d"]
    documents = [(i, ". ".join([p] * 3), "en") for i, p in enumerate(pairs)]
    expected = ["a b", "c d", "z y", "é f"]
    assert [r[2] for r in collocations(spark.createDataFrame(documents, DOCS), 4)] == expected


def test_scores_beyond_64_bits(spark):
    big = 1 << 62
    words = spark.createDataFrame([(0, "en", "a", big, 0), (1, "en", "b", big, 0)], "id long, lang string, word string, f long, threshold long")
    key = 1 << 32 | 2
    likely = spark.createDataFrame([(key, 0, big - 1, "en", 0)], "p long, q long, n long, lang string, threshold long")
    counts = likely.select("p", "q", "n")
    (row,) = phrases._scored(likely, counts, words).collect()
    assert (row.l, row.r, row.score) == (big, big, 2_000_000 * (big - 1) // (2 * big))


# --- 12 ----------------------------------------------------------------------


def brute_copies(documents):
    texts = [re.sub(r"[ \t-\r]+", " ", t or "") for _, t, *_ in documents]
    groups = defaultdict(list)
    for (i, *_), t in zip(documents, texts, strict=True):
        groups[t].append(i)
    keep = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return Counter((i, keep[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for (i, *_), t in zip(documents, texts, strict=True))


@pytest.mark.parametrize("middle", [-1, 2, 6, 99])
def test_copies_of_odd_inputs_wherever_the_history_ends(docs, middle):
    got = exact_dedup.grouped(docs, F.col("doc_id") <= middle).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == brute_copies(ODD)
    # One row of each group stays, also where id and text are repeated.
    assert Counter(r.text_sha256 for r in got if r.kept) == {h: 1 for *_, h in brute_copies(ODD)}
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_no_rows_no_copies(nothing):
    assert exact_dedup.grouped(nothing, F.lit(True)).collect() == []
    kept, index = exact_dedup.without_repeats(nothing)
    assert kept.columns == nothing.columns and kept.count() == index.count() == 0


def test_rows_are_kept_once_over_several_batches(docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "KEYS", 2)
    first, index = exact_dedup.without_repeats(docs.filter("doc_id <= 3"))
    second, index = exact_dedup.without_repeats(docs.filter("doc_id > 3 or doc_id is null"), index)
    assert first.columns == second.columns == docs.columns
    texts = [re.sub(r"[ \t-\r]+", " ", r.text or "") for r in first.collect() + second.collect()]
    assert sorted(texts) == sorted({re.sub(r"[ \t-\r]+", " ", t or "") for _, t, _ in ODD})
    assert exact_dedup.index_entries(index).agg(F.sum("n")).first()[0] == len(ODD)
    third, _ = exact_dedup.without_repeats(docs, index)
    assert third.count() == 0


def test_the_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 50_000):
        words = rng.integers(0, 1 << 63, (n, 4), dtype=np.uint64)
        # Digests that agree in three of their four words.
        words[: n // 2, :3] = 7
        sizes, bits = exact_dedup.perfect_hash(words)
        assert sorted(exact_dedup.slots(words, sizes, bits)) == list(range(n))
        assert bits.sum() == n


def test_a_digest_that_is_no_member_is_no_repeat(spark):
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(2000)]
    entries = spark.createDataFrame([(bytearray(d), i, i, 1) for i, d in enumerate(digests)], "digest binary, keep_id long, keep_row long, n long")
    index = exact_dedup.build_index(entries.limit(1000), 3)
    held = {bytes(r.digest) for r in exact_dedup.index_entries(index).collect()}
    found = exact_dedup.look_up(index, entries, 3).collect()
    assert len(found) == 2000 and {bytes(r.digest) for r in found if r.member} == held


# --- 13 ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizers():
    read = lambda name: open(f"{alignment.TOKENIZERS}/{name}", "rb").read()  # noqa: E731, SIM115
    return alignment.byte_bpe(read(alignment.BYTE_BPE)), alignment.piece_bpe(read(alignment.PIECE_BPE))


@pytest.fixture(scope="module")
def plain_encoders():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(f"{alignment.TOKENIZERS}/{alignment.BYTE_BPE}")
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=f"{alignment.TOKENIZERS}/{alignment.PIECE_BPE}")


def brute_alignment(documents, plain_encoders):
    """Tokens by encoding each text whole, links by comparing byte ranges, groups by walking both sides."""
    a, b = plain_encoders
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}
    told, linked = [], Counter()
    for i, text, *_ in documents:
        ids = [], []
        if text:
            ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            bytes_a = [bytes(letters[c] for c in a.id_to_token(x)) for x in ids[0]]
            bytes_b = [bytes([int(b.id_to_piece(x)[3:5], 16)]) if b.is_byte(x) else b.id_to_piece(x).replace("▁", " ").encode() for x in ids[1]]
            if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ids = [], []
        links, groups = [], ""
        if ids[0]:
            ends = [list(np.cumsum([len(x) for x in side])) for side in (bytes_a, bytes_b)]
            j = 0
            for x, (lo, hi) in enumerate(zip([0, *ends[0]], ends[0], strict=False)):
                while ends[1][j] <= lo:
                    j += 1
                k = j
                while k < len(ends[1]) and (ends[1][k - 1] if k else 0) < hi:
                    links.append((ids[0][x], ids[1][k]))
                    k += 1
            at = [0, 0]
            for cut in sorted(set(ends[0]) & set(ends[1])):
                sides = []
                for s in (0, 1):
                    n = bisect.bisect(ends[s], cut)
                    sides.append(",".join(map(str, ids[s][at[s] : n])))
                    at[s] = n
                groups += "|".join(sides) + ";"
        linked.update(links)
        told.append((i, len(ids[0]), len(ids[1]), groups.count(";"), links, hashlib.sha256(groups[:-1].encode()).hexdigest() if groups else ""))
    most = defaultdict(int)
    for (_, y), c in linked.items():
        most[y] = max(most[y], c)
    return Counter((i, na, nb, g, len(links), sum(linked[x] == most[x[1]] for x in links), sum(linked[x] for x in links), h) for i, na, nb, g, links, h in told)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_of_the_given_documents_equals_brute_force(spark, plain_encoders):
    documents = duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall()
    got = catalog.QUERIES["op13_token_alignment"](spark, SF_DIR).collect()
    assert Counter(tuple(r[c] for c in COLUMNS) for r in got) == brute_alignment(documents, plain_encoders)


def test_alignment_of_odd_inputs(docs, nothing, plain_encoders, monkeypatch):
    expected = brute_alignment(ODD, plain_encoders)
    assert Counter(tuple(r[c] for c in COLUMNS) for r in alignment.alignment_figures(docs).collect()) == expected
    # However the rows fall into batches and blocks.
    monkeypatch.setattr(alignment, "BATCH", 50)
    monkeypatch.setattr(alignment, "BLOCK", 100)
    assert Counter(tuple(r[c] for c in COLUMNS) for r in alignment.alignment_figures(docs).collect()) == expected
    assert alignment.alignment_figures(nothing).collect() == alignment.aligned_groups(nothing).collect() == []


def test_units_are_encoded_as_their_text_is(tokenizers, plain_encoders):
    rng = random.Random(8)
    pieces = ["a", "The", "word", "don't", "'s", "123", "4.5", "é", "日本", "ß", "▁", " ", "　", "​", "\t", "\n", "\r\n", "  ", " ", " ", " ", "!", "...", "\x1c", "\x85", "\U0001f600", "́", "<s>"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    found = alignment.align(texts, alignment.Units(*tokenizers))
    for side, encode in ((0, lambda t: plain_encoders[0].encode(" " + t, add_special_tokens=False).ids), (1, plain_encoders[1].encode)):
        at = np.searchsorted(found.doc[side], np.arange(len(texts) + 1))
        for i, t in enumerate(texts):
            assert list(found.ids[side][at[i] : at[i + 1]]) in ([], encode(t))
    kept = set(found.doc[0])
    assert all(i in kept for i, t in enumerate(texts) if "▁" not in t)


def test_groups_cover_the_text(docs, tokenizers):
    rows = alignment.aligned_groups(docs).filter("doc_id = 8 or doc_id = 2").orderBy("doc_id", "group").collect()
    assert [r.group for r in rows if r.doc_id == 2] == list(range(sum(r.doc_id == 2 for r in rows)))
    text = b" " + dict((i, t) for i, t, _ in ODD)[2].encode()
    spelt = [b"".join(tokenizers[0].pieces[i] for i in r.a_ids) for r in rows if r.doc_id == 2]
    assert b"".join(spelt) == text
    assert spelt == [text[r.start : r.end] for r in rows if r.doc_id == 2]
    # The text with U+2581 is not spelt by B's tokens.
    assert not [r for r in rows if r.doc_id == 8]
