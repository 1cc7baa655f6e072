"""Odd inputs: nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import base64
import hashlib
import random
import struct
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from fiscalframe.llm import decontaminate, language_id, line_dedup, lsh_forest, mixing, pivot_topk, sharding, shingles, surrogates, url_filter, warc
from fiscalframe.llm.components import components
from fiscalframe.llm.shared import with_position
from fiscalframe.sources.outputs import scratch_path

#: Names that the operators use for columns of their own.
CLASHING = ("size", "source_size", "target", "copies", "taken", "score", "lang_pred", "shard", "slot", "root", "n", "rank", "kept", "n_entities", "bytes", "unit", "text_hash", "class_id")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"wort{i}" for i in range(60_000))
PROSE = "the quick brown fox jumps over the lazy dog near the old river bank"
ODD = [
    (1, PROSE, "en", "a", 1),
    (1, PROSE, "en", "a", 1),
    (2, PROSE + " today", "en", None, 2),
    (3, None, "en", "b", None),
    (4, "", None, "b", 0),
    (5, " \t\n ", "de", None, 4),
    (6, LONG, "de", "c", len(LONG)),
    (7, "x" * 300_000, "de", "c", 300_000),
    (None, PROSE, None, "a", 1),
    (None, None, None, None, None),
    (8, "one", "en", "a", 3),
    (9, "12 34 !!", "en", "a", 8),
    (10, "\ud7ff\uffff \U0010ffff naïve ÉTÉ\x00nul", "fr", "d", 9),
]


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame(ODD, DOCS)
    return plain.select("*", *[F.lit("mine").alias(c) for c in CLASHING])


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def given(docs):
    return Counter(map(repr, docs.collect()))


# --- 1 -----------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, score string, rank string, id string"


def brute_topk(vectors, k=10):
    use = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out, asked = [], set()
    for q, v in use:
        if q % 100 == 0 and (q, tuple(v)) not in asked:
            asked.add((q, tuple(v)))
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in use if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_topk_of_odd_vectors(spark):
    rng = random.Random(1)
    vectors = [(i, [rng.gauss(0, 0.2) for _ in range(8)]) for i in range(1, 400)]
    same = [0.5] * 8
    vectors += [(i, same) for i in range(400, 700)] + [(100, same), (100, same)]
    vectors += [(900, None), (901, [1.0, None]), (902, [float("nan")]), (903, [float("inf")] * 8), (904, []), (905, [2.0, 1.0]), (None, same)]
    df = spark.createDataFrame([(i, v, 0, "x", "y", "z") for i, v in vectors], VECTORS)
    got = pivot_topk.pivot_topk(df, F.col("vec_id") % 100 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute_topk(vectors)


def test_topk_of_large_components_is_exact(spark):
    rng = random.Random(11)
    # Sums beyond 2**53 that differ by less than a float can tell, next to one component of 1e9.
    vectors = [(i, [2.0**10, 2.0**10 - rng.randint(0, 3), rng.randint(-500, 500) / 1024]) for i in range(300)]
    vectors += [(300, [1e9, 0.0, 1 / 1024]), (301, [0.0, 3e6]), (302, [-1.0, 1.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = pivot_topk.pivot_topk(df, F.col("vec_id") % 100 == 0)
    whole = {i: [int(1024 * x // 1) for x in v] for i, v in vectors}
    expected = []
    for q in (0, 100, 200, 300):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=False)), i) for i, v in whole.items() if i != q)
        expected += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:10], 1)]
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_topk_with_few_or_no_candidates(spark):
    few = [(0, [1.0]), (1, [2.0]), (2, [3.0])]
    df = spark.createDataFrame([(i, v, 0, "", "", "") for i, v in few], VECTORS)
    assert rows(pivot_topk.pivot_topk(df, F.col("vec_id") % 100 == 0), "rank", "vec_id") == [(1, 2), (2, 1)]
    assert pivot_topk.pivot_topk(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []
    assert pivot_topk.pivot_topk(df.filter("vec_id > 0"), F.col("vec_id") % 100 == 0).collect() == []


# --- 2 -----------------------------------------------------------------------


def test_surrogates_of_odd_documents(spark, docs, nothing):
    out = surrogates.pseudonymized(docs, b"key")
    assert out.columns == [c for c in docs.columns if c != "n_entities"] + ["n_entities"]
    assert rows(out, "doc_id", "text") == rows(docs, "doc_id", "text")
    assert surrogates.pseudonymized(nothing, b"key").count() == 0


ENTITIES = """Mrs. Anna Kelly wrote to Mr. Tom Kelly: a.kelly@mail.example.com, A.KELLY@MAIL.EXAMPLE.COM.
г-жа Анна Петрова, +1 (017) 555-7713, 4539 1488 0343 6467, 4539148803436467, 10.0.0.1, 078-05-1120,
DE89 3704 0044 0532 0130 00, token = "0123456789abcdef0123456789abcdef" and κα Μαρία Παππά."""


def test_surrogates_keep_kind_form_gender_and_script(spark):
    df = spark.createDataFrame([(1, ENTITIES), (2, ENTITIES)], "doc_id long, text string")
    first, second = [r.text for r in surrogates.pseudonymized(df, b"key").collect()]
    assert first == second
    old, new = surrogates.detect(ENTITIES), surrogates.detect(first)
    assert [k for *_, k, _ in old] == [k for *_, k, _ in new]
    pairs = {(k, v): w for (*_, k, v), (*_, w) in zip(old, new, strict=True)}
    assert all(v != w for (_, v), w in pairs.items()) and len(set(pairs.values())) == len(pairs)
    shape = lambda t: "".join("9" if c.isdigit() else c for c in t if not c.isalpha())
    for (a, b, k, _), (c, d, *_) in zip(old, new, strict=True):
        if k in ("phone", "card", "ssn", "email"):
            assert shape(ENTITIES[a:b]) == shape(first[c:d])
    assert surrogates._luhn(pairs["card", "4539148803436467"]) == 0
    assert pairs["name-female", "anna"].endswith("nia") and pairs["name-male", "tom"].endswith("n")
    assert pairs["name-family", "петрова"].endswith("рд") and pairs["name-female", "μαρία"].endswith("νη")


def test_one_person_under_many_titles_is_one(spark):
    texts = [
        "Mrs Anna Stone left.", "Prof. Anna Stone came. Later Stone left with Anna Stone.", "Dr Anna's ANNA", "Mr Juan Carlos García de la López",
        "Sr Carlos Vega", "Mr Robin Hill", "Mrs Robin Hill", "Stone and Anna and Robin", "Dr. Stone's report",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = [r.text for r in sorted(surrogates.pseudonymized(df, b"key").collect())]
    anna, stone = out[0].split()[1:3]
    assert anna.endswith("nia") and stone.endswith("rd")
    assert out[0] == f"Mrs {anna} {stone} left."
    assert out[1] == f"Prof. {anna} {stone} came. Later {stone} left with {anna} {stone}."
    assert out[2] == f"Dr {anna}'s {anna.upper()}" and out[8] == f"Dr. {stone}'s report"
    juan, carlos, garcia, lopez = (out[3].split()[i] for i in (1, 2, 3, 6))
    assert out[3] == f"Mr {juan} {carlos} {garcia} de la {lopez}" and not {juan, carlos, garcia, lopez} & set(texts[3].split())
    assert out[4].split()[1] == carlos
    # Two genders tell none; a text without a title has no name to go by.
    assert out[5].split()[1] == out[6].split()[1] and out[5].split()[1].endswith("l") and out[7] == texts[7]


def test_surrogates_keep_case_script_and_check_digits(spark):
    secrets = ["AbCdEfGh1234", "abcdefgh1234", "ABCDEFGH1234", "AB" * 16, "ab" * 16]
    texts = [f"token      =     '{s}'" for s in secrets] + ["Max.Muster@Mail.org max.muster@mail.org", "٠٥٥-١٢٣-٤٥٦٧ 055-123-4567", "DE89 3704 0044 0532 0130 00"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = [r.text for r in sorted(surrogates.pseudonymized(df, b"key").collect())]
    made = [t.split("'")[1] for t in out[:5]]
    assert len(set(made)) == 5 and not set(made) & set(secrets)
    case = lambda t: [(c.isupper(), c.islower(), c.isdigit()) for c in t]
    assert [case(m) for m in made[:3]] == [case(s) for s in secrets[:3]]
    assert set(made[3]) <= set("0123456789ABCDEF") and set(made[4]) <= set("0123456789abcdef")
    mixed, plain = out[5].split()
    assert mixed.lower() == plain and case(mixed) == case("Max.Muster@Mail.org") and mixed.endswith(".org")
    native, ascii_ = out[6].split()
    assert "".join(str(int(c)) if c.isdigit() else c for c in native) == ascii_ and all(c == "-" or "٠" <= c <= "٩" for c in native)
    iban = out[7].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1 and iban[:2] == "DE" and iban != texts[7].replace(" ", "")


def test_planted_entities_are_all_replaced_and_nothing_else(spark):
    """Brute force: texts put together from clear parts and known entities, taken apart again by the clear parts."""
    entities = [
        *[f"user{i}.x@mail{i % 7}.example.org" for i in range(60)], *[f"+49 (0{i}) 555-{1000 + i}" for i in range(10, 60)],
        *[f"{100 + i}-22-{3000 + i}" for i in range(40)], *[f"10.{i}.3.{i}" for i in range(40)], *[f"4000 1234 5678 {9000 + i}" for i in range(40)],
        *[f"{i:032x}" for i in range(2**80, 2**80 + 40)],
    ]
    clear = ["call ", " or write to ", "; then see ", " (page 12 of 2024). ", " costs 3.50 and "]
    rows, planted = [], {}
    for d in range(300):
        chosen = [entities[(d * 7 + j * 31) % len(entities)] for j in range(d % 5)]
        planted[d] = chosen
        rows.append((d, "".join(c + e for c, e in zip(clear, chosen, strict=False)) + " end"))
    made: dict[str, str] = {}
    for r in surrogates.pseudonymized(spark.createDataFrame(rows, "doc_id long, text string"), b"key").collect():
        assert r.n_entities == len(planted[r.doc_id]) and r.text.endswith(" end")
        rest = r.text[:-4]
        parts = []
        for c in reversed(clear[: len(planted[r.doc_id])]):
            rest, found, last = rest.rpartition(c)
            assert found
            parts.append(last)
        assert rest == ""
        for e, new in zip(planted[r.doc_id], reversed(parts), strict=True):
            assert made.setdefault(e, new) == new and len(new) == len(e) or "." in e
    assert len(set(made.values())) == len(made) and not set(made.values()) & set(entities)


def test_surrogates_that_collide_draw_again(spark):
    # 90 of the 100 two-character locals there are: many draws meet, and meet real ones.
    values = [f"{c}{d}@x.org" for c in "abcdefghi" for d in range(10)]
    df = spark.createDataFrame([("email", v) for v in values], "kind string, value string")
    made = {r.value: r.surrogate for r in surrogates.entity_map(df, b"key").collect()}
    assert set(made) == set(values) and len(set(made.values())) == len(values)
    assert not set(made.values()) & set(values)


# --- 3 -----------------------------------------------------------------------


def test_mixture_of_odd_documents(spark, docs, nothing):
    out = mixing.mixture(docs)
    assert out.count() == len(ODD)
    assert rows(out, "size")[0] == (0,) and mixing.mixture(nothing).count() == 0 and mixing.mix(nothing).count() == 0
    assert all(t <= 3 * s for s, t in rows(out, "size", "taken"))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and set(given(mixed)) <= set(given(docs))
    taken = sum(n for (n,) in rows(out, "copies"))
    assert mixed.count() == taken == mixing.mix(docs).count()


@pytest.mark.parametrize("doc_id", [None, 7])
def test_documents_without_an_id_of_their_own_come_near_their_target(spark, doc_id):
    table = [(doc_id, f"word{i} " * 10, None, f"s{i % 4}", 0) for i in range(10_000)]
    df = spark.createDataFrame(table, DOCS)
    sources = df.select("source", mixing.word_count(F.col("text")).alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = {r.source: r.target for r in mixing.source_targets(sources).collect()}
    got = {r.source: r.words for r in mixing.mix(df).groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("words")).collect()}
    assert {s: got[s] == pytest.approx(t, rel=0.05) for s, t in wanted.items()} == {f"s{i}": True for i in range(4)}


def test_targets_share_all_and_stop(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 1), ("c", 1), ("ä", 0), (None, 500)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert got["b"] == 3.0 and got["c"] == 3.0 and got["ä"] == 0.0
    assert sum(got.values()) == pytest.approx(1502) and got[None] == pytest.approx(2 * got["a"])


def test_sources_come_near_their_targets(spark):
    rng = random.Random(3)
    table = [(i, "w " * rng.randint(1, 200), None, f"s{min(i % 8, 4)}", 0) for i in range(6000)]
    out = mixing.mixture(spark.createDataFrame(table, DOCS))
    for total, target in out.groupBy("source_size").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).select("t", "g").collect():
        assert abs(total - target) < 0.1 * target


# --- 4 -----------------------------------------------------------------------


def brute_rule(rules, host, path):
    fitting = []
    for rule, verdict in rules:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            fitting.append((h.count("."), len(p), verdict == "block", rule, verdict))
    return max(fitting)[3:] if fitting else (None, "allow")


def test_urls_against_brute_force(spark):
    rng = random.Random(4)
    rules = [("com/", "allow"), ("a.com/x/", "block"), ("a.com/x", "allow"), ("b.a.com/", "block"), ("a.com/x/y", "allow"), ("org", "block"), ("a.org/x/", "allow"), ("a.org/x/", "block")]
    urls = ["".join(rng.choice(["http://", "a.", "b.", "com", "org", "/", "x", "/x/", "y", "?", "#", "A.", "://"]) for _ in range(rng.randint(1, 9))) for _ in range(2000)]
    urls += [None, "", "://", "http://a.com", "http://a.com/x/y/z", "h://" + "a." * 50_000 + "com/" + "x/" * 50_000]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit(1)).withColumn("host", F.lit(2))
    for r in url_filter.judge_urls(df, rules).collect():
        url = urls[r.page_id] or ""
        rest = url.partition("://")[2]
        host = rest[: min(rest.find(c) if c in rest else len(rest) for c in "/?#")]
        path = rest[len(host) :].split("?")[0].split("#")[0]
        assert (r.host, r.path) == (host.lower(), path)
        assert (r.rule, r.verdict) == brute_rule(rules, r.host, r.path), url
    assert url_filter.judge_urls(df.limit(0), rules).count() == 0


# --- 5 -----------------------------------------------------------------------


def test_lines_of_odd_documents(spark, docs, nothing):
    got = {r.doc_id: r for r in line_dedup.kept_lines(docs).collect()}
    assert got[1].kept == [0] and got[2].kept == [] and got[2].n_removed == 1
    assert (got[3].n_lines, got[3].kept) == (0, []) and (got[4].n_lines, got[4].n_blank) == (1, 1)
    assert got[5].n_blank == 2 and got[6].kept == [0] and got[7].kept == [0]
    assert line_dedup.kept_lines(nothing).count() == 0
    texts = line_dedup.without_repeated_lines(docs)
    assert texts.columns == docs.columns and texts.count() == len(ODD)
    assert {(r.doc_id, r.text) for r in texts.collect() if r.doc_id in (1, 2, 3, 5)} == {(1, PROSE), (2, ""), (3, None), (5, " \t\n ")}


def test_many_versions_of_a_line(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(30)]
    lines = [" ".join(rng.choice([w, w, w, w, w, w, w, w, w, w, f"v{rng.random()}"]) for w in base) for _ in range(300)]
    df = spark.createDataFrame([(i, "\n".join(lines[3 * i : 3 * i + 3])) for i in range(100)], "doc_id long, text string")
    sets, expected = [], {}
    for i in range(100):
        kept = []
        for j in range(3):
            s = frozenset(lines[3 * i + j].split())
            if not any(9 * len(s & t) >= 4 * (len(s) + len(t)) for t in sets):
                kept.append(j)
            sets.append(s)
        expected[i] = kept
    assert {r.doc_id: r.kept for r in line_dedup.kept_lines(df).collect()} == expected


def test_pairs_of_a_family_that_is_not_near(spark, monkeypatch):
    """Versions that share two thirds of their words are told apart before their words are compared."""
    rng, kept = random.Random(7), {}
    base = [f"w{i}" for i in range(100)]
    lines = []
    for i in range(150):
        at = set(rng.sample(range(100), 10))
        lines.append(" ".join(f"v{i}.{j}" if j in at else w for j, w in enumerate(base)))
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    plain = line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda out, label: kept.setdefault(label, plain(out, label)))
    got = {r.doc_id: r.n_kept for r in line_dedup.kept_lines(df).collect()}
    sets = [set(line.split()) for line in lines]
    near = [[i for i in range(j) if 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j]))] for j in range(150)]
    assert got == {j: int(not before) for j, before in enumerate(near)}
    assert kept["pairs"].count() <= 150 * 149 // 2 // 5


# --- 6 -----------------------------------------------------------------------


def test_leaks_in_odd_documents(spark, docs, nothing):
    items = spark.createDataFrame([(1, PROSE), (2, None), (3, ""), (4, "short"), (None, "x" * 2000), (5, "fox jumps over the lazy dog near the OLD   river")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaked_regions(docs, items).collect()}
    assert {(1, 1), (2, 1), (None, 1), (1, 5), (7, None)} <= found and not {d for d, _ in found} & {3, 4, 5, 6, 8, 9, 10}
    clean = decontaminate.decontaminated(docs, items)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {3, 4, 5, 6, 8, 9, 10, None}
    assert decontaminate.leaked_regions(nothing, items).count() == 0
    assert decontaminate.leaked_regions(docs, items.limit(0)).count() == 0 and decontaminate.decontaminated(docs, items.limit(0)).count() == len(ODD)


def semi_global(pattern, text):
    """Least edits of the pattern anywhere in the text, by the plain matrix."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        above, row = row, [i]
        for j, y in enumerate(text, 1):
            row.append(min(above[j - 1] + (x != y), above[j] + 1, row[-1] + 1))
    return min(row)


def test_leaks_of_short_items_equal_brute_force_over_edits():
    rng = random.Random(61)
    items = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(40, 120))).strip() for _ in range(12)]
    items = [" ".join(t.split()) for t in items]
    index = decontaminate.build_index(list(enumerate(items)))
    texts = []
    for item in items * 3:
        edited = list(item)
        for _ in range(rng.randint(0, 14)):
            at = rng.randrange(len(edited))
            edited[at : at + 1] = rng.choice(([], ["#"], [edited[at], "#"]))
        texts.append("zzz " + "".join(edited) + " yyy")
    caught = 0
    for text, found in zip(texts, decontaminate.find_regions(index, texts), strict=True):
        expected = {i for i, item in enumerate(items) if semi_global(item, text) <= index.edits[index.item.index(i)]}
        assert {r["item_id"] for r in found} == expected
        for r in found:
            assert r["share"] == 1 and semi_global(items[r["item_id"]], text) == r["edits"]
        caught += bool(expected)
    assert 0 < caught < len(texts)


def test_leaked_parts_and_repeated_copies_are_regions():
    rng = random.Random(62)
    words = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))
    long_, middle, short = words(165), words(50) + ".", "twenty-two characters."
    index = decontaminate.build_index([(1, long_), (2, middle), (3, short)])
    edited = long_[:570] + "#" + long_[571:580] + "#" + long_[581:]
    texts = ["before " + edited + " behind", " x ".join([short] * 4), words(20) + " " + middle[40:320] + " " + words(20), middle + middle, words(300)]
    one, four, part, twice, none = decontaminate.find_regions(index, texts)
    assert [(r["start"], r["end"], r["edits"], r["share"]) for r in one] == [(7, 7 + len(long_), 2, 1)]
    assert [(r["start"], r["end"]) for r in four] == [(25 * i, 25 * i + 22) for i in range(4)]
    assert len(part) == 1 and part[0]["item_id"] == 2 and 0.5 < part[0]["share"] < 0.9
    assert [(r["start"], r["end"], r["share"]) for r in twice] == [(0, 350, 1), (350, 700, 1)] and none == []
    # Any 191 characters hold a piece, wherever they begin.
    assert all(decontaminate.find_regions(index, [long_[i : i + 191] for i in range(0, len(long_) - 191, 31)]))


def test_leaks_with_edits_and_in_blocks(spark, monkeypatch):
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz     "
    items = ["".join(rng.choice(letters) for _ in range(rng.randint(60, 900))).strip() for _ in range(40)]
    texts = []
    for i, item in enumerate(items):
        edited = list(item)
        for _ in range(int(0.07 * min(len(" ".join(item.split())), 380))):
            edited[rng.randrange(len(edited))] = rng.choice(letters)
        texts.append((i, "begin " + "".join(edited).upper() + " " + "".join(rng.choice(letters) for _ in range(300))))
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    whole = decontaminate.leaked_regions(spark.createDataFrame(texts, "doc_id long, text string"), table)
    assert {(r.doc_id, r.item_id) for r in whole.collect()} >= {(i, i) for i, t in enumerate(items) if len(t) < 380}
    small = [b for b in decontaminate.benchmark_blocks(table, block_chars=3000)]
    assert len(small) > 3 and sum(len(set(b.item)) for b in small) == 40


# --- 7 -----------------------------------------------------------------------

PAGES = [
    (1, "http://a/\r\nX: y", "<p>ä</p>"), (2, None, "<p>ä</p>"), (2, None, "<p>ä</p>"), (3, "ü 100% ?", None), (4, "", ""),
    (None, "http://n", "<p>ä</p>"), (None, None, "alone"), (5, "http://b", "z" * 2_000_000), (6, "http://c", "\r\n\r\nWARC/1.1\r\n\r\n"),
]


def test_archives_of_odd_pages(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("payload", F.lit(2))
    got = warc.archived(df).collect()
    assert len(got) == len(PAGES) and not [r.error for r in got if r.error]
    expected = []
    for i, url, html in PAGES:
        body = (html or "").encode()
        latest = max((j for j, _, h in PAGES if (h or "") == (html or "") and j is not None), default=None)
        kind = "response" if i == latest else "revisit"
        target = {PAGES[0][1]: "http://a/%0D%0AX:%20y", "ü 100% ?": "%C3%BC%20100%%20?"}.get(url, url)
        expected.append((i, target, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), kind, latest if kind == "revisit" else None))
        if kind == "response":
            assert body in [bytes(r.payload) for r in got if r.page_id == i and r.payload is not None]
    assert sorted(((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == sorted(expected, key=repr)
    assert warc.archived(df.limit(0)).count() == 0


def test_least_payload_for_a_revisit(spark):
    df = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    assert rows(warc.plan_records(df, least=4), "page_id", "record_type") == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response")]


def test_archives_hold_bounded_numbers_and_any_reader_takes_them(spark, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_ARCHIVE", 40)
    df = spark.range(300).select(F.col("id").alias("page_id"), F.lit("http://x").alias("url"), F.concat(F.lit("page "), F.col("id")).alias("html"))
    path = scratch_path(spark, "warc")
    dictionary = warc.train_dictionary(df)
    warc.write_archives(warc.plan_records(df), path, dictionary)
    files = [bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect()]
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    for data in files:
        assert data[:8] == struct.pack("<II", warc.DICTIONARY_FRAME, len(dictionary))
        assert 1 <= len(list(warc.archive_records(data))) <= 40
        # The plain stream reader passes over all skippable frames.
        whole = reader.stream_reader(data, read_across_frames=True).read()
        assert whole == b"".join(warc.archive_records(data))
    assert warc.read_archives(spark, path).filter("error is null").count() == 300


def test_damage_is_told():
    record = warc.record_bytes(1, "http://x", b"body", hashlib.sha1(b"body").digest(), 4, None, "response", warc.DATE)
    assert warc.parse_record(record)["payload"] == b"body"
    for broken in (record[:-1], record.replace(b"body", b"bodi"), record.replace(b"WARC/1.1", b"WARC/9.9"), record.replace(b"WARC-Date", b"WARC-Dete"), b"", record + b"\r\n", record.replace(b"Content-Length: 4", b"Content-Length: 5")):
        with pytest.raises(ValueError):
            warc.parse_record(broken)
    packer = zstandard.ZstdCompressor(write_checksum=True)
    frames = packer.compress(record) + zstandard.ZstdCompressor(write_content_size=False).compress(record * 5000)
    compressed_dictionary = zstandard.ZstdCompressor().compress(b"some dictionary content" * 10)
    lead = struct.pack("<II", warc.DICTIONARY_FRAME, len(compressed_dictionary)) + compressed_dictionary
    assert list(warc.archive_records(lead + frames)) == [record, record * 5000]
    assert [bool(r.get("error")) for r in warc._parsed(frames[:-3])] == [False, True]
    assert [bool(r["error"]) for r in warc._parsed(b"no frame here")] == [True]


# --- 8 -----------------------------------------------------------------------


def test_languages_of_odd_documents(spark, docs, nothing):
    model = language_id.fit(docs)
    out = language_id.predict(docs, model)
    assert out.columns == [c for c in docs.columns if c not in ("lang_pred", "score")] + ["lang_pred", "score"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in out.collect() if r.doc_id is not None}
    assert got[1][0] == got[2][0] == "en" and got[6][0] == "de"
    assert all(got[i] == ("und", 0.0) for i in (3, 4, 5, 9))
    kept = language_id.keep_identified(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 2, 6, 7, 8, 10, None}
    assert language_id.predict(nothing, model).count() == 0
    empty = language_id.fit(nothing)
    assert {r.lang_pred for r in language_id.predict(docs, empty).select("lang_pred").collect()} == {"und"}


def test_training_sample_is_bounded(spark):
    words = spark.range(4000).select(F.concat(F.lit("wort "), F.col("id")).alias("text"), F.lit("de").alias("lang"))
    full, thin = language_id.fit(words, sample=10_000), language_id.fit(words, sample=100)
    assert full.languages == thin.languages == ["de"]
    assert thin.log_likelihood.max() > full.log_likelihood.min()


# --- 9 -----------------------------------------------------------------------


def test_near_duplicates_of_odd_documents(spark, docs, nothing):
    got = lsh_forest.near_duplicates(docs, words=4).collect()
    assert len(got) == len(ODD)
    component = {r.doc_id: r.component_id for r in got}
    assert component[1] == component[2] == 1 and component[8] == 8 and component[3] == 3 and component[5] == 5
    assert {r.n_shingles for r in got if r.doc_id in (3, 4, 5)} == {0} and {r.n_shingles for r in got if r.doc_id == 8} == {1}
    assert sorted(r.component_id or 0 for r in got if r.doc_id is None) == [0, 1]
    left = lsh_forest.drop_near_copies(docs, words=5)
    assert left.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in left.select("doc_id").collect()) == [(False, i) for i in (1, 3, 4, 5, 6, 7, 8, 9, 10)] + [(True, 0)]
    assert lsh_forest.near_duplicates(nothing).count() == 0 and lsh_forest.drop_near_copies(nothing).count() == 0


def test_shingle_kernel_against_plain_sets():
    rng = random.Random(9)
    texts = ["".join(rng.choice(["a", "B", "ß", " ", "\n", "\x0b", "ab", "\u2028"]) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    sets, begins = shingles.shingle_sets(texts, 3)
    seen = {}
    for t, i, j in zip(texts, begins, begins[1:], strict=False):
        words = t.encode().lower().split()
        plain = {tuple(words[k : k + 3]) for k in range(len(words) - 2)} if len(words) >= 3 else {tuple(words)} - {()}
        assert j - i == len(plain)
        assert seen.setdefault(frozenset(plain), tuple(sets[i:j])) == tuple(sets[i:j])
    assert len(set(seen.values())) == len(seen)


def test_a_family_of_versions_around_one_text(spark):
    """More versions than a region holds: the hub joins those near it, and no link is lost."""
    rng = random.Random(10)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(base)] * 3 + [" ".join(f"v{rng.random()}" if rng.random() < rng.choice([0.01, 0.03, 0.06]) else w for w in base) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [frozenset(zip(*[t.split()[i:] for i in range(4)], strict=False)) for t in texts]
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                a, b = sorted((find(root, i), find(root, j)))
                root[b] = a
    got = {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(df, words=4).collect()}
    assert got == {i: find(root, i) for i in range(len(sets))}


def find(root, i):
    while root[i] != i:
        i = root[i]
    return i


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100)] + [(1000, i) for i in range(1001, 1400)] + [(2000, 2001)] * 3
    got = {r.id: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(101)) and all(got[i] == 1000 for i in range(1000, 1400)) and got[2001] == 2000
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 10 ----------------------------------------------------------------------


def test_shards_of_odd_documents(spark, docs, nothing):
    out = sharding.shard_documents(docs)
    got = out.collect()
    assert len(got) == len(ODD) and {r.law for r in got} == {"bytes"}
    assert {(r.size, r.text_crc32) for r in got if r.doc_id in (3, 4)} == {(1, None), (1, 0)}
    by_shard = Counter(r.shard for r in got)
    assert sorted((r.shard, r.slot) for r in got) == [(s, i) for s in sorted(by_shard) for i in range(by_shard[s])]
    assert len({r.shard for r in got if r.size == len(PROSE) + 1}) == 1
    assert sharding.shard_documents(nothing).count() == 0


def test_differencing_beats_greedy_and_keeps_a_giant_apart():
    assert sorted(sharding.difference([8, 7, 6, 5, 4], 2)) and abs(spread([8, 7, 6, 5, 4], 2)) <= 2
    rng = random.Random(11)
    sizes = [int(rng.lognormvariate(8, 1.5)) for _ in range(3000)]
    assert spread(sizes, 8) <= 3
    where = sharding.difference([10**9, *sizes], 8)
    assert where.count(where[0]) == 1
    assert sharding.difference([], 8) == [] and sharding.difference([5], 8) == [0]


def spread(sizes, parts):
    totals = [0] * parts
    for s, p in zip(sizes, sharding.difference(sizes, parts), strict=True):
        totals[p] += s
    return max(totals) - min(totals)


def test_positions_follow_the_order(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("x")).repartition(7)
    assert all(r.x == r.at for r in with_position(df, [F.col("x")], "at").collect())
