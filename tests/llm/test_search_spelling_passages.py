"""Ranked search, spelling groups and repeated passages against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tierflow.llm import spelling
from tierflow.llm.lexical_search import ranked_search, term_weight, terms_of
from tierflow.llm.queries import QUERIES
from tierflow.llm.spelling import near_words, plan_rounds, roots, spelling_variants
from tierflow.llm.substring_dedup import without_repeats
from tierflow.llm.wordhash import Words, window_hashes

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, word string, n int, row string, item string"
LONG = " ".join(f"w{k * k % 977}" for k in range(6000))
PASSAGE = " ".join(f"passage{k}" for k in range(50))
AWKWARD = [
    (1, "Alpha beta gamma alphabet alphabet", "x", 1, "r", "i"),
    (2, f"before {PASSAGE} after", None, 2, None, None),
    (2, f"before {PASSAGE} after", None, 2, None, None),
    (3, None, None, None, None, None),
    (4, "", "y", 4, "r", "i"),
    (4, " \t\n", "y", 4, "r", "i"),
    (None, f"other\t{PASSAGE}\x0bend", "z", 5, "r", "i"),
    (6, LONG, "l", 6, "r", "i"),
    (7, LONG.replace("w976", "v976"), "l", 7, "r", "i"),
    (8, "Straße straße Ünïcode ünïcode ×× ÀÀÀÀÀÀÀÀ ẞ 漢字 été alphabets alphabet", "u", 8, "r", "i"),
    (9, "alphabet " * 60, "s", 9, "r", "i"),
    (10, PASSAGE + " Alphabet alphabot alphabot", "s", 10, "r", "i"),
    (11, "aaaaaaaa aaaaaaa aaaaaaaa aaaaaaa " + "b" * 3000 + " " + "b" * 3000 + " " + "b" * 2999 + " " + "b" * 2999, "s", 0, "r", "i"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# hashes of words and windows


def test_word_hashes_depend_on_the_words_alone():
    texts = ["a bb  ccc", None, "", "ccc\ta bb", "x" * 70, "a bb ccc a"]
    words = Words(pa.array(texts))
    split = [(t or "").split() for t in texts]
    assert np.diff(words.bounds).tolist() == [len(s) for s in split]
    flat = [w for s in split for w in s]
    by_word = defaultdict(set)
    for word, value in zip(flat, words.hashes.tolist(), strict=True):
        by_word[word].add(value)
    assert all(len(v) == 1 for v in by_word.values())
    assert len({v for s in by_word.values() for v in s}) == len(by_word)
    first, last = words.bounds[3], words.bounds[4]
    assert bytes(words.text(first, last)) == b"ccc a bb"
    assert words.kept(first, np.array([True, False, True])) == b"ccc bb"
    runs = window_hashes(words.hashes, 2)
    assert runs[0] == runs[first + 1] != runs[1]


# ranked search


def brute_search(rows, items, k=10):
    vectors = [(d, Counter(terms_of(t))) for d, t in rows]
    held = [(d, v, sum(v.values())) for d, v in vectors if v]
    n_docs, length = len(held), sum(n for *_, n in held)
    df = Counter(t for _, v, _ in held for t in v)
    asked = defaultdict(Counter)
    for item, text in items:
        asked[item].update(terms_of(text))
    out = []
    for item, query in asked.items():
        scored = []
        for doc, vector, n in held:
            m = 100 - 75 + 75 * n * n_docs // length
            score = sum(
                c * term_weight(n_docs, df[t]) * (1000000000 * vector[t] // (1000 * vector[t] + 8 * m))
                for t, c in query.items()
                if t in vector
            )
            if score > 0:
                scored.append((-score, doc is not None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return out


def test_terms():
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    text = "Ab9_c'd É-\x80x [Z] @q{y}~ ẞß"
    lower = text.translate({i: i + 32 for i in range(65, 91)})
    assert [t.decode() for t in terms_of(text)] == pattern.findall(lower)
    assert terms_of(None) == [] == terms_of(" -- ")
    assert term_weight(10, 10) == math.floor(1000 * math.log(22 / 21))


ITEMS = [(1, "alphabet passage3 w4"), (2, None), (3, ""), (1, "ALPHABET w9"), (None, "gamma"), (5, PASSAGE), (6, "nowhere")]


@pytest.mark.parametrize("block_terms", [200_000, 3])
def test_search_equals_brute_force(spark, docs, as_rows, block_terms):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = ranked_search(docs, items, k=3, block_terms=block_terms)
    expected = brute_search([(d, t) for d, t, *_ in AWKWARD], ITEMS, k=3)
    assert as_rows(found) == sorted(expected, key=repr)


def test_search_of_many_copies_keeps_the_smallest_ids(spark, as_rows):
    rows = [(k, "copied words here" if k % 3 else f"words {k}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    items = [(1, "copied here"), (2, "words"), (3, "words 42 copied")]
    found = ranked_search(docs, spark.createDataFrame(items, "item_id bigint, text string"))
    assert as_rows(found) == sorted(brute_search(rows, items), key=repr)


def test_search_of_empty_tables(spark, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert ranked_search(empty, items).count() == 0
    assert ranked_search(docs, items.limit(0)).count() == 0
    nulls = docs.withColumn("text", F.lit(None).cast("string"))
    assert ranked_search(nulls, items).count() == 0


# spelling variants


def brute_spelling(rows, min_length=7, every=31, ratio=10):
    seen = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({i: i + 32 for i in range(65, 91)})
            h = zlib.crc32(f"{doc}:{run}".encode())
            if doc is not None and every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_length:
                seen[run] += 1
    words = {w: n for w, n in seen.items() if n >= 2}
    masks = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            masks[w[:k] + "\0" + w[k + 1 :]].add(w)
    near = {w: set() for w in words}
    for w in words:
        for k in range(len(w)):
            near[w] |= masks[w[:k] + "\0" + w[k + 1 :]] - {w}
            if (less := w[:k] + w[k + 1 :]) in words:
                near[w].add(less)
                near[less].add(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best and words[best] >= ratio * words[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return [(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()]


@pytest.mark.parametrize("every", [31, 2, 0])
def test_spelling_equals_brute_force(docs, as_rows, every):
    found = spelling_variants(docs, misspell_every=every, ratio=2)
    expected = brute_spelling([(d, t) for d, t, *_ in AWKWARD], every=every, ratio=2)
    assert as_rows(found) == sorted(expected, key=repr)


def test_spelling_on_the_table_in_several_rounds(spark, as_rows):
    """Filters of 4 KB take many rounds, with lengths cut into parts; the result is the same."""
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    expected = sorted(brute_spelling([tuple(r) for r in rows.collect()]), key=repr)
    assert as_rows(QUERIES["op12_spelling_variants"](spark, FOLDER)) == expected
    words = spelling.vocabulary_of(rows)
    lengths = Counter(len(r.word) for r in words.collect())
    plans = plan_rounds(lengths, filter_bytes=4096)
    assert len(plans) > 3 and max(p.size for p in plans) * 64 <= 4096
    assert any(parts > 1 for p in plans for *_, parts in p.shards.values())
    assert as_rows(spelling_variants(rows, filter_bytes=4096)) == expected


def test_near_words_of_one_family(spark, as_rows):
    """A hot neighbourhood: every variant of one word by one letter."""
    base = "abcdefgh"
    words = {base: 5} | {base[:k] + c + base[k + 1 :]: 1 for k in range(8) for c in "xyz"} | {base[:k] + base[k + 1 :]: 1 for k in range(8)}
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    pairs = as_rows(near_words(table).select("word", "near"))
    assert len(pairs) == len({frozenset(p) for p in pairs})
    one = {frozenset((a, b)) for a in words for b in words if a < b and _edit_one(a, b)}
    assert {frozenset(p) for p in pairs} == one


def _edit_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def test_roots_follow_long_chains(spark):
    chain = [(f"w{k}", f"w{k + 1}") for k in range(37)]
    led = roots(spark.createDataFrame(chain, "word string, form string"))
    assert {tuple(r) for r in led.collect()} == {(w, "w37") for w, _ in chain}


def test_spelling_of_empty_tables(docs, empty):
    assert spelling_variants(empty).count() == 0
    assert spelling_variants(docs.withColumn("text", F.lit(None).cast("string"))).count() == 0


# repeated passages


def brute_passages(rows, width):
    texts = [(d, re.findall("[^\x20\x09-\x0d]+", t or "")) for d, t in rows]
    seen = Counter(tuple(w[k : k + width]) for _, w in texts for k in range(len(w) - width + 1))
    out = []
    for doc, words in texts:
        gone = set()
        for k in range(len(words) - width + 1):
            if seen[tuple(words[k : k + width])] > 1:
                gone.update(range(k, k + width))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("width", [35, 11, 5, 1])
@pytest.mark.parametrize("hash_bits", [64, 9])
def test_passages_equal_brute_force(docs, as_rows, width, hash_bits):
    """With nine hash bits nearly all windows clash, which must not change anything."""
    found = without_repeats(docs, width=width, hash_bits=hash_bits)
    expected = brute_passages([(d, t) for d, t, *_ in AWKWARD], width)
    assert as_rows(found) == sorted(expected, key=repr)


@pytest.mark.parametrize("hash_bits", [64, 16])
def test_passages_of_near_copies(spark, as_rows, hash_bits):
    """Families of edited copies, copies inside a document, and runs of one word."""
    rng = np.random.default_rng(5)
    rows = []
    for family in range(4):
        base = [f"f{family}w{k}" for k in rng.integers(0, 60, 150)]
        for copy in range(12):
            words = list(base)
            for k in rng.integers(0, len(words), 4):
                words[k] = f"edit{copy}"
            rows.append((len(rows), "  ".join(words[: int(rng.integers(20, 150))])))
    rows.append((len(rows), " ".join(["same"] * 90)))
    rows.append((len(rows), rows[0][1] + "\n" + rows[0][1]))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = without_repeats(docs, width=12, hash_bits=hash_bits)
    assert as_rows(found) == sorted(brute_passages(rows, 12), key=repr)


def test_passages_of_empty_tables(docs, empty):
    assert without_repeats(empty).count() == 0
    nulls = without_repeats(docs.withColumn("text", F.lit(None).cast("string"))).collect()
    assert {(r.n_words, r.n_removed) for r in nulls} == {(0, 0)} and len(nulls) == len(AWKWARD)
