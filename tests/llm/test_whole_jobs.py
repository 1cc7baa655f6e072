"""Cases in which an operator once did less than its whole job."""

import random
import sys
import time

import pytest
import regex
from pyspark.sql import functions as F

from fiscalframe.llm import lsh_forest, surrogates

# --- 2 -----------------------------------------------------------------------

WRITTEN = (
    "٠٥٥-١٢٣-٤٥٦٧", "۰۵۵-۱۲۳-۴۵۶۷", "०५५-१२३-४५६७", "४५३९ १४८८ ०३४३ ६४६७", "١٠.٠.٠.١", "०७८-०५-११२०", "+٩٦٦ ٥٥ ١٢٣ ٤٥٦٧",
    "token\u2003=\u00a0'abcdefgh'", "key:\x85\u2028\u3000\"abcdefgh\"", "почта ваня@пример.рф", "г-жа Анна", "κα Μαρία", "abcdef" * 6, "Password = 'geheimnis'",
)


def test_the_filter_passes_all_that_is_detected(spark):
    every = "".join(map(chr, range(sys.maxunicode + 1)))
    zeros = regex.findall(r"\d", every)[::10]
    phones = ["{0}{0}{0}-{0}{0}{0}-{0}{0}{0}{0}".format(z) for z in zeros]
    secrets = [f"secret={c}'abcdefgh'" for c in regex.findall(r"\s", every)]
    texts = [*WRITTEN, *phones, *secrets]
    assert all(surrogates.detect(t) for t in texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [texts[r.doc_id] for r in df.filter(~F.col("text").rlike(surrogates.HINT)).collect()] == []


def test_numbers_in_native_digits_are_replaced_alike(spark):
    number = WRITTEN[0]
    df = spark.createDataFrame([(1, f"اتصل {number}"), (2, f"اتصل {number} 7")], "doc_id long, text string")
    one, two = sorted(surrogates.pseudonymized(df, b"key").collect())
    assert one.n_entities == two.n_entities == 1 and number not in one.text + two.text
    assert f"{one.text} 7" == two.text


def test_long_entities_are_found_whole():
    for n in (8, 512, 513, 5000, 1_000_000):
        value = "aB3-" * (n // 4) + "x" * (n % 4)
        assert surrogates.detect(f'token = "{value}" end') == [(9, 9 + n, "secret", value)]
    for n in (32, 128, 129, 4096, 1_000_000):
        assert surrogates.detect(f"id {'c' * n} end") == [(3, 3 + n, "secret", "c" * n)]
    for n in (1, 64, 65, 3000):
        local, label = "l" * n, "d" * n
        assert surrogates.detect(f"to {local}@{label}.example.org end") == [(3, 3 + 2 * n + 13, "email", f"{local}@{label}.example.org")]


def test_long_runs_take_linear_time():
    for text in ("x" * 1_000_000 + "@", "key='" * 200_000, "key='" + "y" * 1_000_000, "c" * 1_000_000 + "g", "a@" + "d." * 500_000):
        started = time.process_time()
        surrogates.detect(text)
        assert time.process_time() - started < 20


# --- 9 -----------------------------------------------------------------------


def shingle_sets(texts, words=4):
    return [frozenset(zip(*[t.split()[i:] for i in range(words)], strict=False)) for t in texts]


def brute_components(texts, percent, words=4):
    sets = shingle_sets(texts, words)
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                a, b = sorted((find(root, i), find(root, j)))
                root[b] = a
    return {i: find(root, i) for i in range(len(sets))}


def find(root, i):
    while root[i] != i:
        i = root[i]
    return i


def template_pairs(pairs):
    """Texts of one template, 0.79 alike, two by two 0.81 alike: their hub is near to none but one."""
    rng = random.Random(12)
    template = " ".join(f"w{i}" for i in range(79))
    word = lambda: f" v{rng.random()}"
    texts = []
    for _ in range(pairs):
        both = template + word()
        texts += [both + "".join(word() for _ in range(9)) for _ in range(2)]
    rng.shuffle(texts)
    return texts


def test_versions_of_a_template_whose_hub_is_far(spark):
    texts = template_pairs(300)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = brute_components(texts, 80)
    assert len(set(expected.values())) == 300
    for partitions in (1, 7):
        got = lsh_forest.near_duplicates(df.repartition(partitions), words=4).collect()
        assert {r.doc_id: r.component_id for r in got} == expected


def test_lower_similarities_are_refused(spark):
    """Below 80 percent the sketch would lose links without a word."""
    df = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    with pytest.raises(ValueError, match="80 percent"):
        lsh_forest.near_duplicates(df, percent=79)
    with pytest.raises(ValueError, match="80 percent"):
        lsh_forest.drop_near_copies(df, percent=60)
