"""The corpus operators against brute force, on fixtures with the awkward cases."""

import base64
import bisect
import bz2
import gzip
import lzma
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from tierflow.llm import exact_dedup, ngram_join, packing, secrets, vector_graph
from tierflow.llm.common import stored
from tierflow.llm.components import components
from tierflow.llm.language import UNDECIDED, learn_dictionaries, predict_language
from tierflow.llm.mixing import mixed, mixing_rates
from tierflow.llm.ngram_join import jaccard_join, keep_one_per_component
from tierflow.llm.packing import pack_documents, plan_patterns
from tierflow.llm.perplexity import classify_quality
from tierflow.llm.pii import leftovers, with_surrogates
from tierflow.llm.queries import ORACLES, QUERIES
from tierflow.llm.sharding import byte_shards
from tierflow.llm.vector_graph import near_duplicate_vectors

FOLDER = "/root/testdata/sf0.001"
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "doc_id bigint, text string, lang string, digest string, rank int"
LONG = "".join(f"w{k * k % 977} " for k in range(6000))
AWKWARD = [
    (1, "one two three four five", "en", "x", 1),
    (2, " one\ttwo three\nfour five ", "en", None, 2),
    (2, " one\ttwo three\nfour five ", "en", None, 2),
    (3, None, None, None, None),
    (4, "", "en", "y", 4),
    (None, "one two three four five", "en", "z", 5),
    (6, LONG, "en", "l", 6),
    (7, LONG.replace("w976", "v976"), "en", "l", 7),
    (8, "Ünïcode ẞ 漢字   x", "de", "u", 8),
    (9, "a b", "en", "s", 9),
    (10, "A  B", "en", "s", 10),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# sharding


def test_shards_are_contiguous_and_even(docs):
    rows = byte_shards(docs, shards=3).collect()
    assert len(rows) == len(AWKWARD)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in AWKWARD
    )
    rows.sort(key=lambda r: (r.shard, r.slot))
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    for shard in {r.shard for r in rows}:
        assert [r.slot for r in rows if r.shard == shard] == list(
            range(sum(r.shard == shard for r in rows))
        )


def test_shards_of_equal_rows_are_even(spark):
    same = spark.range(4000).select(F.lit(5).cast("bigint").alias("doc_id"), F.lit("abc").alias("text"))
    sizes = Counter(r.shard for r in byte_shards(same, shards=16).collect())
    assert set(sizes.values()) == {250}


# exact duplicates


def brute_groups():
    groups = defaultdict(list)
    for d, t, *_ in AWKWARD:
        groups["".join(c for c in (t or "") if c not in " \t\n\x0b\x0c\r")].append((d, t))
    return groups


@pytest.mark.parametrize("bits", [64, 2])
def test_exact_duplicates(docs, bits):
    """With two hash bits nearly all chunks clash, which must not change anything."""
    rows = exact_dedup.exact_duplicates(docs, hash_bits=bits).collect()
    assert len(rows) == len(AWKWARD)
    expected = Counter()
    for members in brute_groups().values():
        best = min(members, key=lambda m: (-len(m[1] or ""), m[0] is None, m[0] or 0))
        for d, _ in members:
            expected[(d, best[0], len(members))] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in rows) == expected
    assert sum(r.kept for r in rows) == len(brute_groups())


def test_dropping_exact_duplicates_keeps_one_row_and_all_columns(docs):
    left = exact_dedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    assert left.count() == len(brute_groups())
    assert [r.doc_id for r in left.filter("doc_id = 2").collect()] == [2]


def test_number_signs_are_no_letters():
    from tierflow.llm.language import classify

    model = (("de", b"der die das und"), ("en", b"the and of to"))
    assert [classify(t, model)[0] for t in ("½ ²", "Ⅷ", "12 _", "٣", "")] == [UNDECIDED] * 5
    assert classify("a 1", model)[0] != UNDECIDED != classify("漢", model)[0]


# n-gram join


def brute_join(rows, width, percent):
    sets = {}
    for d, t, *_ in rows:
        words = (t or "").encode().lower().split()
        shingles = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}
        if words and len(words) < width:
            shingles = {tuple(words)}
        sets.setdefault(d, shingles)
    ids = sorted(k for k in sets if k is not None)
    lead = {k: k for k in ids}

    def root(k):
        while lead[k] != k:
            k = lead[k]
        return k

    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((root(a), root(b)))
                    lead[y] = x
    return {k: root(k) for k in ids}, sets


def test_join_of_awkward_rows(docs):
    found, _ = jaccard_join(docs, width=4, percent=85)
    rows = found.collect()
    wanted, sets = brute_join(AWKWARD, 4, 85)
    assert len(rows) == len(AWKWARD)
    for r in rows:
        assert r.n_shingles == len(sets[r.doc_id])
        assert r.component_id == (1 if r.doc_id is None else wanted[r.doc_id])
    assert keep_one_per_component(docs, found).filter("doc_id = 10").count() == 0


def test_join_of_a_large_group_near_the_threshold(spark):
    """One text with edits: long lists, leads, blocks of members and stragglers all occur."""
    draw = np.random.default_rng(7)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for k in range(150):
        words = base.copy()
        for at in draw.choice(120, draw.integers(0, 7), replace=False):
            words[at] = f"e{k}x{at}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, " ".join(base[:70] + [f"o{k}y{j}" for j in range(50)])) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found, _ = jaccard_join(df, width=4, percent=85)
    wanted, _ = brute_join(rows, 4, 85)
    assert {r.doc_id: r.component_id for r in found.collect()} == wanted


def test_join_of_families_with_one_link_at_the_threshold(spark):
    """Lists shared by two families, whose larger part is now the one and now the other."""
    rows, wanted = [], {}
    for seed in range(16):
        rng = np.random.default_rng(seed)
        one = [f"s{seed}w{k}" for k in range(300)]
        spots = np.arange(10, 290, 25)[:11]
        other = [f"{w}b" if k in spots else w for k, w in enumerate(one)]
        family = [[f"{w}b" if k in spots[:5] else w for k, w in enumerate(one)], other]
        for base in (one, other):
            for j in range(20):
                words = list(base)
                words[rng.choice(np.setdiff1d(np.arange(4, 296), spots))] += f"m{j}{base[10][-1]}"
                family.append(words)
        part = [(1000 * seed + k, " ".join(family[i])) for k, i in enumerate(rng.permutation(len(family)))]
        rows += part
        wanted |= brute_join(part, 4, 85)[0]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found, _ = jaccard_join(df, width=4, percent=85)
    assert {r.doc_id: r.component_id for r in found.collect()} == wanted


def linked_sets(sets, percent):
    """Pairs of positions that link, by Python sets."""
    found = set()
    for a, x in enumerate(sets):
        for b, y in enumerate(sets):
            common = len(x & y)
            if x and y and 100 * common >= percent * (len(x) + len(y) - common):
                found.add((a, b))
    return found


def test_blocks_of_visitors_and_members_give_the_smallest_member(monkeypatch):
    """The matrix of a block, over several runs of columns, against Python sets."""
    monkeypatch.setattr(ngram_join, "COLUMNS", 16)
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for k in range(40):
        words = list(base)
        for at in rng.integers(0, 60, size=k % 5):
            words[at] = f"e{k}x{at}"
        texts.append(" ".join(words))
    texts += ["nothing in common with any other of these", "short one", "", None]
    names = rng.permutation(len(texts)).tolist()
    visitor = [k % 3 == 0 for k in range(len(texts))]
    table = pa.table({"node": pa.array(names, pa.int64()), "text": texts, "visitor": visitor})
    sets = [brute_join([(0, t)], 4, 85)[1][0] or set() for t in texts]
    wanted = {}
    for a, b in linked_sets(sets, 85):
        if visitor[a] and not visitor[b]:
            wanted[names[a]] = min(wanted.get(names[a], len(texts)), names[b])
    found = ngram_join._first_links(4, 85)(table).to_pylist()
    assert {r["x"]: r["y"] for r in found} == wanted and len(wanted) > 5
    alone = table.filter(pa.array(visitor))
    assert ngram_join._first_links(4, 85)(alone).num_rows == 0


def test_components_that_nearly_link_cost_no_row_for_each_pair(spark, monkeypatch):
    """Two families just below the threshold, and one member that joins two others."""
    monkeypatch.setattr(ngram_join, "COUNTED_SETS", 5)
    stored_rows = {}

    def counted(df, name, **options):
        table = stored(df, name, **options)
        stored_rows[name] = max(stored_rows.get(name, 0), table.count())
        return table

    monkeypatch.setattr(ngram_join, "stored", counted)
    rng, rows, wanted = np.random.default_rng(3), [], {}
    for group, apart in enumerate((13, 10)):
        one = [f"g{group}w{k}" for k in range(300)]
        spots = np.arange(10, 295, 23)[:apart]
        other = [f"{w}b" if k in spots else w for k, w in enumerate(one)]
        half = [f"{w}b" if k in spots[:5] else w for k, w in enumerate(one)]
        family = [half] if group else []
        for base in (one, other):
            for j in range(40):
                words = list(base)
                words[rng.choice(np.setdiff1d(np.arange(4, 296), spots))] += f"m{j}{base[10][-1]}"
                family.append(words)
        part = [(1000 * group + k, " ".join(family[i])) for k, i in enumerate(rng.permutation(len(family)))]
        rows += part
        wanted |= brute_join(part, 4, 85)[0]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found, _ = jaccard_join(df, width=4, percent=85)
    assert {r.doc_id: r.component_id for r in found.collect()} == wanted
    assert len(set(wanted.values())) == 3
    assert stored_rows["join-visits"] <= 2 * len(rows)
    assert stored_rows["join-hosts"] <= 2 * len(rows)


def test_near_copies_that_do_not_link_cost_no_row_for_each_pair(spark, monkeypatch):
    """Copies with two edits each, without and with the text that they were made from."""
    monkeypatch.setattr(ngram_join, "COUNTED_SETS", 16)
    stored_rows = {}

    def counted(df, name, **options):
        table = stored(df, name, **options)
        stored_rows[name] = max(stored_rows.get(name, 0), table.count())
        return table

    monkeypatch.setattr(ngram_join, "stored", counted)
    rng, rows = np.random.default_rng(11), []
    for group, edits in enumerate(((2, 2), (2, 3))):
        base = [f"g{group}w{k}" for k in range(150)]
        family = [" ".join(base)] if group else []
        for k in range(80):
            words = list(base)
            for at in rng.choice(np.arange(0, 150, 5), edits[k % 2], replace=False):
                words[at] = f"e{k}x{at}"
            family.append(" ".join(words))
        rows += [(1000 * group + k, family[i]) for k, i in enumerate(rng.permutation(len(family)))]
    # Two that share an edit link with each other alone.
    words = [f"g0w{k}" for k in range(150)]
    for at in (20, 60, 100):
        words[at] += "z"
    rows += [(500 + k, " ".join([*words[:140], f"last{k}", *words[141:]])) for k in range(2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found, _ = jaccard_join(df, width=4, percent=85)
    wanted, _ = brute_join(rows, 4, 85)
    assert {r.doc_id: r.component_id for r in found.collect()} == wanted
    assert wanted[501] == 500 and len(set(wanted.values())) > 60
    assert stored_rows["join-visits"] <= 4 * len(rows), stored_rows


def test_links_of_each_document_are_counted(spark, monkeypatch):
    """A group with links and other pairs inside, equal sets, and blocks of few sets."""
    monkeypatch.setattr(ngram_join, "COUNTED_SETS", 7)
    rng, base = np.random.default_rng(2), [f"w{k}" for k in range(120)]
    rows = []
    for k in range(50):
        words = list(base)
        for at in rng.integers(0, 120, size=k % 4):
            words[at] = f"e{k}x{at}"
        rows.append((k, " ".join(words)))
    rows += [(100, rows[5][1].upper()), (101, None), (102, "all alone here today"), (None, rows[1][1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found, _ = jaccard_join(df, width=4, percent=85, count_links=True)
    sets = {d: brute_join([(d, t)], 4, 85)[1][d] for d, t in rows}

    def linked(a, b):
        common = len(sets[a] & sets[b])
        return common > 0 and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common)

    wanted = {a: sum(linked(a, b) for b in sets if b is not None and b != a) for a in sets}
    assert {r.doc_id: r.n_links for r in found.collect()} == wanted
    assert len(set(wanted.values())) > 5


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)]
    found = components(spark.createDataFrame(links, "x bigint, y bigint"), "x", "y").collect()
    assert {r.node: r.component for r in found} == {
        **dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)
    }


def test_empty_tables_and_clashing_names(docs, empty):
    assert byte_shards(empty).count() == 0
    assert exact_dedup.exact_duplicates(empty).count() == 0
    assert exact_dedup.drop_exact_duplicates(empty).count() == 0
    assert jaccard_join(empty)[0].count() == 0
    assert pack_documents(empty, RANKS, PATTERN).count() == 0
    names = {"digest": "_row", "rank": "_text", "lang": "dropped"}
    odd = docs.withColumnsRenamed(names)
    assert mixed(odd, docs.select(F.col("doc_id").alias("id"), F.lit("a").alias("domain")), {"a": 1}).columns == odd.columns
    assert with_surrogates(odd, "key").columns == [*odd.columns, "n_entities"]
    assert exact_dedup.drop_exact_duplicates(odd).columns == odd.columns
    decided, _ = jaccard_join(odd)
    assert keep_one_per_component(odd, decided).columns == odd.columns


# secrets


def spans_of(text):
    return [(secrets.KINDS[k], text[a:b]) for a, k, b in secrets.scan(text)[1]]


SECRET = 'password = "Hunter2Hunter2xx'


def test_layers_are_opened_and_mapped():
    plain = base64.b64encode(f"note é {SECRET}".encode()).decode()
    zipped = base64.b64encode(gzip.compress(base64.b64encode(SECRET.encode()), mtime=0)).decode()
    escaped = "".join(f"\\u{ord(c):04x}" for c in SECRET)
    double = "".join(f"%25{ord(c):02X}" for c in SECRET)
    assert spans_of(SECRET) == [("assign", SECRET)]
    assert len(spans_of(f"x {plain} y")) == 1
    assert spans_of(f"x {zipped} y") == [("assign", zipped)]
    assert spans_of(f"x {escaped} y") == [("assign", escaped)]
    assert spans_of(f"x {double} y") == [("assign", double)]
    assert spans_of("token=short secret: abcdefghijklmnop") == [("assign", "secret: abcdefghijklmnop")]
    # A short run is dropped; its letters are spent.
    assert spans_of("token=secret:abcdefghijklmnop") == []
    assert secrets.scan("%2525" * 4)[2] == 2


def test_a_repeated_encoded_secret_is_reported_at_every_place():
    plain = base64.b64encode(SECRET.encode() + b"xx").decode()
    escaped = "".join(f"\\u{ord(c):04x}" for c in plain)
    text = f"a {plain} b\n{escaped} c {plain}"
    found = secrets.scan(text)[1]
    assert [text[a:b] for a, _, b in found] == [plain, escaped, plain]


def test_large_layers_hide_nothing():
    line = "".join(f"line {k % 10} " for k in range(99)) + "\n"
    big = line * (2 * secrets.MAX_LAYER // len(line)) + SECRET
    blob = base64.b64encode(gzip.compress(big.encode(), mtime=0)).decode().rstrip("=")
    percent = "".join(f"%{b:02X}" for b in gzip.compress(big.encode(), mtime=0))
    plain = base64.b64encode(SECRET.encode() + b"xx").decode()
    for first in (blob, percent):
        text = f"{first} then {plain}"
        base, found, _, large = secrets.scan(text)
        assert (large, [text[a:b] for a, k, b in found if k == 0]) == (1, [first, plain])


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lzma.compress, zstandard.compress])
def test_all_members_and_wrapped_lines_are_read(pack):
    packed = pack(b"nothing here, " * 9) + pack(SECRET.encode())
    whole = base64.b64encode(packed).decode().rstrip("=")
    assert ("assign", whole) in spans_of(f"x {whole} y")
    lines = "\n".join(whole[k : k + 64] for k in range(0, len(whole), 64))
    assert ("assign", lines) in spans_of(f"x\n{lines}\ny")
    wrapped = base64.encodebytes(b"0123456789" * 5 + SECRET.encode()).decode()
    (found,) = [t for k, t in spans_of(f"x\n{wrapped}") if k == "assign"]
    assert "\n" in found


def test_secret_rows(docs, empty):
    rows = secrets.find_secrets(docs).collect()
    assert len(rows) == len(AWKWARD)
    assert {r.spans for r in rows if r.doc_id in (3, 4)} == {""}
    assert secrets.find_secrets(empty).count() == 0


# packing


def test_patterns_cover_the_histogram():
    draw = np.random.default_rng(3)
    histogram = Counter(int(x) for x in draw.integers(1, 257, 3000))
    plan = plan_patterns(histogram, 256)
    covered = Counter()
    for pattern, times in plan:
        assert sum(n * k for n, k in pattern.items()) <= 256
        for n, k in pattern.items():
            covered[n] += k * times
    assert covered == histogram
    # Column generation stops before its optimum here: best fit alone takes 1498 sequences
    # (0.4 % over the least), this plan 1624 (8.9 %). A known weakness, see the README.
    least = sum(n * k for n, k in histogram.items()) / 256
    assert sum(times for _, times in plan) <= 1.05 * least


def test_packing_takes_the_special_token_as_its_tokenizer_does(spark):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "<|endoftext", "plain"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in pack_documents(df, RANKS, PATTERN).collect()}
    for k, text in enumerate(texts):
        ids = [*reference.encode(text, add_special_tokens=False).ids, 0]
        assert got[k] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_packing_needs_no_more_sequences_than_best_fit(spark):
    """On the table, and on lengths drawn evenly, against a plain best fit piece by piece."""
    rows = QUERIES["op7_packing"](spark, "/root/testdata/sf0.01").select("sequence_id", "length").collect()
    even = np.random.default_rng(4).integers(1, 1024, 3000).tolist()
    for lengths, used in (
        ([r.length for r in rows], len({r.sequence_id for r in rows})),
        (even, sum(n for _, n in plan_patterns(Counter(even), 1024))),
    ):
        rooms = []
        for size in sorted(lengths, reverse=True):
            at = bisect.bisect_left(rooms, size)
            room = rooms.pop(at) if at < len(rooms) else 1024
            bisect.insort(rooms, room - size)
        least = -(-sum(lengths) // 1024)
        assert least <= used <= len(rooms)
        assert used <= 1.02 * least


def test_packing_round_trip(docs):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = pack_documents(docs, RANKS, PATTERN, capacity=256).collect()
    sequences, seen = defaultdict(list), Counter()
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        seen[(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)] += 1
    wanted = Counter()
    for d, t, *_ in AWKWARD:
        ids = [*reference.encode(t or "", add_special_tokens=False).ids, 0]
        for at in range(0, len(ids), 256):
            piece = np.array(ids[at : at + 256], "<u4")
            wanted[(d, at, len(piece), zlib.crc32(piece.tobytes()), len(ids))] += 1
    assert seen == wanted
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.END_ID == 0


# language


def test_language(spark, docs, empty):
    source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    learned = learn_dictionaries(source.filter("doc_id % 2 = 0"))
    seen = predict_language(source.filter("doc_id % 2 = 1"), learned).collect()
    assert sum(r.lang == r.lang_pred for r in seen) >= 0.93 * len(seen)
    assert all(0 <= r.score <= 1 for r in seen)
    odd = {r.doc_id: r for r in predict_language(docs, learned).collect()}
    assert odd[3].lang_pred == odd[4].lang_pred == UNDECIDED and odd[3].rejected
    assert predict_language(docs, {}).filter("not rejected").count() == 0
    assert learn_dictionaries(empty) == {}
    clash = predict_language(docs.withColumnRenamed("rank", "Score"), learned)
    assert clash.columns[-3:] == ["lang_pred", "_score", "rejected"] and clash.count() == len(AWKWARD)


# mixing


def test_rates_reach_the_targets(spark):
    source = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    known = labels.select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "good").otherwise("bad").alias("domain"))
    rows = mixing_rates(source, known, {"good": 3, "bad": 1}).collect()
    totals = [sum(r.tokens * r.rate * r.posterior[k] for r in rows) for k in (0, 1)]
    assert sum(totals) == pytest.approx(sum(r.tokens for r in rows), rel=1e-4)
    assert totals[0] == pytest.approx(3 * totals[1], rel=1e-3)
    assert all(r.rate >= 0 for r in rows)
    left = mixed(source, known, {"good": 3, "bad": 1}, anchor="good")
    assert left.columns == source.columns and left.count() > 0


def test_mixing_of_awkward_rows(docs, empty):
    known = docs.sparkSession.createDataFrame([(1, "a"), (6, "b"), (None, "a"), (77, "b")], "id bigint, domain string")
    assert mixing_rates(docs, known, {"a": 1, "b": 1}).count() == len(AWKWARD)
    assert mixing_rates(empty, known, {"a": 1, "b": 1}).count() == 0
    assert mixed(docs, known.limit(0), {"a": 1, "b": 1}).columns == docs.columns


# quality


def test_quality_tells_junk_from_prose(spark, docs, empty):
    source = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    trusted = labels.filter("quality = 1 and toxic = 0").select(F.col("doc_id").alias("id"))
    rows = classify_quality(source, trusted, RANKS, PATTERN).join(labels, "doc_id").collect()
    clean = [r.kept for r in rows if (r.quality, r.toxic) == (1, 0)]
    junk = [r.kept for r in rows if r.quality == 0]
    assert sum(clean) >= 0.97 * len(clean) and sum(junk) <= 0.1 * len(junk)
    few = classify_quality(docs, trusted, RANKS, PATTERN).collect()
    assert len(few) == len(AWKWARD)
    assert {r.kept for r in few if r.doc_id in (3, 4)} == {False}
    assert classify_quality(empty, trusted, RANKS, PATTERN).count() == 0


def test_model_is_a_distribution(spark):
    """Probabilities of all next tokens add up to 1 after a seen and an unseen context."""
    from tierflow.llm import perplexity as P

    ids = [[5, 6, 7, 5, 6, 8], [5, 6, 7, 9], [6, 7, 5, 5]]
    keys, counts = np.unique(np.concatenate([P.bigrams(i) for i in ids]), return_counts=True)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"keys": [P.packed(keys)], "counts": [P._squeezed(counts)]})
    model = P.Model(pa.Table.from_batches(list(P._token_facts(iter([batch])))))
    known = dict(zip(keys.tolist(), counts.tolist(), strict=True))
    for context in (5, 123):
        line = (np.uint32(context) << np.uint32(16) | np.arange(P.VOCABULARY, dtype=np.uint32)) * P.SPREAD
        seen = np.array([known.get(int(k), 0) for k in line])
        assert np.exp(model.log_prob(line, seen)).sum() == pytest.approx(1, abs=1e-6)


# personal data


PRIVATE = [
    (1, "Mail Bob.Smith7@mail.example.com, call +1 (743) 555-3824 or +1-743-555-3824, card 4111 1111 1111 1111."),
    (2, "Mr John Smith met Mrs Anna Smith; Mr Smith left 10.1.2.3. Господин Иванов"),
    (3, None),
    (4, ""),
    (5, "BOB.SMITH7@MAIL.EXAMPLE.COM +1 (743) 555-3824"),
    *[(10 + k, f"{c}@mail.example.com") for k, c in enumerate("abcdefghijklmnopqrstuvwxyz")],
]


def test_surrogates(spark, empty):
    before = spark.createDataFrame(PRIVATE, "doc_id bigint, text string")
    after = with_surrogates(before, "key")
    text = {r.doc_id: r.text for r in after.collect()}
    assert text[3] is None and text[4] == ""
    assert leftovers(before, after).count() == 0
    mail = text[1].split()[1].rstrip(",")
    assert text[5].split()[0] == mail.upper()
    first, second = text[1].split("call ")[1].split(", card")[0].split(" or ")
    assert [c for c in first if c.isdigit()] == [c for c in second if c.isdigit()]
    card = [int(c) for c in text[1].split("card ")[1] if c.isdigit()]
    assert sum(d if k % 2 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(card)) % 10 == 0
    surnames = text[2].replace(";", "").split()
    assert surnames[2] == surnames[6] == surnames[8] and "10." in text[2]
    short = [text[10 + k] for k in range(26)]
    assert len(set(short)) == 26
    assert {r.doc_id: r.text for r in with_surrogates(before, "other").collect()} != text
    assert with_surrogates(empty, "key").count() == 0


# vectors


def test_vectors_that_share_an_id_are_counted_once(spark):
    v, other = [1.0, 2.0, 2.0], [5.0, -1.0, 0.0]
    rows = [(1, v), (1, v), (3, [2.0, 4.0, 4.0]), (None, v), (9, other)]
    found, _ = near_duplicate_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), threshold=0.9)
    links = {r.vec_id: (r.n_links, r.component_id) for r in found.collect() if r.vec_id is not None}
    assert links == {1: (1, 1), 3: (1, 1), 9: (0, 9)}


def test_vectors_against_brute_force(spark):
    draw = np.random.default_rng(11)
    vectors = draw.normal(size=(400, 16)).tolist()
    for k in range(120):
        vectors.append((np.array(vectors[k % 3]) + draw.normal(size=16) * 0.15).tolist())
    vectors += [vectors[0]] * 30
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(vectors)]
    odd = [(9000, None), (9001, [0.0] * 16), (9002, [float("nan")] * 16), (9003, [1.0, 2.0]), (9004, [None] * 16)]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>").repartition(4)
    found, recall = near_duplicate_vectors(df, threshold=0.9)
    got = {r.vec_id: r for r in found.collect()}
    assert len(got) == len(rows) + len(odd) and recall >= 0.95
    units = np.array([v for _, v in rows])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    true = (units @ units.T >= 0.9).sum(axis=1) - 1
    counts = np.array([got[k].n_links for k, _ in rows])
    assert (counts <= true).all() and counts.sum() >= 0.95 * true.sum()
    for k, _ in odd:
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (0, k, True)
    assert near_duplicate_vectors(df.limit(0))[0].count() == 0


def test_vectors_of_a_hot_group_that_many_centres_cut_up(spark, monkeypatch):
    """Near copies in different cells; overlap alone leaves most of their pairs out."""
    monkeypatch.setattr(vector_graph, "CLUSTER", 8)
    draw = np.random.default_rng(5)
    base, vectors = draw.normal(size=64), draw.normal(size=(1600, 64))
    vectors[::3] = base + draw.normal(size=(len(vectors[::3]), 64)) * 0.24
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    found, recall = near_duplicate_vectors(df, threshold=0.9, overlap=5)
    got = {r.vec_id: r for r in found.collect()}
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    close = units @ units.T >= 0.9
    assert [got[k].n_links for k in range(len(rows))] == (close.sum(axis=1) - 1).tolist()
    assert recall == 1.0
    parts = components(
        spark.createDataFrame(np.argwhere(close).tolist(), "x bigint, y bigint"), "x", "y"
    )
    wanted = {r.node: r.component for r in parts.collect()}
    assert all(r.component_id == wanted.get(k, k) for k, r in got.items())


# queries


def test_oracles_match(spark):
    import duckdb

    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{FOLDER}/documents.parquet'")
    for name, sql in ORACLES.items():
        got = QUERIES[name](spark, FOLDER)
        cursor = connection.execute(sql)
        names = [c[0] for c in cursor.description]
        assert sorted(map(repr, cursor.fetchall())) == sorted(
            repr(tuple(r[c] for c in names)) for r in got.collect()
        ), name


def test_pipeline_keeps_columns_and_packs_what_is_left(spark):
    import corpus_pipeline
    from tierflow.llm.common import stored

    source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = source
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, FOLDER), name)
        assert docs.columns == source.columns, name
    assert 0 < docs.select("doc_id").distinct().count() < source.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.filter("start = 0").count() == docs.count()
