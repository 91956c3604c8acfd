"""Collocations, decontamination and Merkle proofs against plain versions of their rules."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import collocations, decontaminate, merkle
from tallyfold.llm.queries import LLM_ORACLES, LLM_QUERIES

SF = "/root/testdata/sf0.001"
#: The columns of documents, and some whose names the operators use themselves.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n int, phrase string, place int, spans string, leaf string, _tree string, k int, own int, chunk string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in all columns, empty and very long texts, ties, repeated rows, columns with clashing names."""
    rng = random.Random(7)
    words = "ab cd ef gh éé IJ 12 x-y".split()
    long = " ".join(rng.choice(words) for _ in range(20_000))
    texts = [None, "", " \t\n.,", "one", "A a. a A", long, long, long[:900], "the cat sat. the cat sat! The Cat\tsat; the cat", "ü É\n\nÜ é"]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(40))) for _ in range(40)]
    rows = [(i, t, ("en", "fr", None)[i % 3], ("s0", "s1", None, "")[i % 4], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[8], rows[8], (None, "the cat sat", None, None, None), (None,) * 5]
    return spark.createDataFrame([(*r, 1, "p", 2, "s", "l", "t", 3, 4, "c") for r in rows], DOCS)


@pytest.fixture(scope="module")
def nothing(odd):
    return odd.where("doc_id < 0")


def lower(text):
    return (text or "").encode().lower().decode()


# --- collocations -------------------------------------------------------------
def plain_collocations(rows, least, top=2000, longest=5):
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n-\r]", lower(text)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            for size in range(1, longest + 1):
                for k in range(len(words) - size + 1):
                    counts[lang, *words[k : k + size]] += 1
    candidates = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    parts = defaultdict(int)
    for (lang, *words), a in candidates.items():
        for size in range(2, len(words)):
            for k in range(len(words) - size + 1):
                part = lang, *words[k : k + size]
                parts[part] = max(parts[part], a)
    ranked = defaultdict(list)
    for (lang, *words), a in candidates.items():
        if parts[lang, *words] >= a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, *words[:k]], counts[lang, *words[k:]]
            cuts.append((int(Fraction(1000 * a * total[lang], left * right)), k, left, right))
        score, _, left, right = min(cuts)
        ranked[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return {
        (lang, i + 1, phrase.decode(), -a, left, right, total[lang], -score)
        for lang, rows in ranked.items()
        for i, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top])
    }


@pytest.mark.parametrize("options", [{}, {"spread": 1}, {"spread": 3, "filter_bits": 64, "held_words": 50, "range_bytes": 1000}])
def test_collocations(odd, options):
    want = plain_collocations([(r.lang, r.text) for r in odd.collect()], 3)
    got = collocations.mine(odd, least=3, **options)
    assert {tuple(r) for r in got.collect()} == want
    assert len({r[0] for r in want}) == 3


def test_the_best_phrases_only(odd):
    want = plain_collocations([(r.lang, r.text) for r in odd.collect()], 2, top=7)
    assert {tuple(r) for r in collocations.mine(odd, least=2, top=7).collect()} == want


def test_collocations_of_nothing(nothing):
    assert collocations.mine(nothing).count() == 0


def test_chunks_own_every_word_once():
    rng = random.Random(3)
    for size in [1, 2, 4, 5, 6, 7, 300]:
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(size)]
        for spread in (1, 2, 5):
            found = collocations.chunks(words, 4, spread)
            at = 0
            for own, n in found:
                assert own == words[at : at + len(own)] and 0 < n <= len(own)
                assert len(own) == n + 4 or own is found[-1][0]
                at += n
            assert at == size
    # Where a passage is cut depends on the passage alone.
    passage = [b"w%d" % k for k in range(200)]
    one = {tuple(own) for own, _ in collocations.chunks([b"x"] * 9 + passage, 4, 8)}
    two = {tuple(own) for own, _ in collocations.chunks([b"y"] * 30 + passage, 4, 8)}
    assert len(one & two) >= len(one) - 2 > 5


def test_repeated_text_is_one_chunk(spark):
    text = " ".join(f"w{k}" for k in range(100))
    docs = spark.createDataFrame([("en", text)] * 50, "lang string, text string").coalesce(1)
    (row,) = collocations.parse(docs).collect()
    words = collocations._Chunks(*row)
    assert len(words.distinct) == 100 and words.own.sum() == 100 and len(words.ids) > 100
    assert set(words.weights.tolist()) == {50} and words.total() == 5000


def test_scores_are_exact(spark):
    for a, n, left, right in [(10**16 + 1, 10**17 + 3, 10**16 + 7, 10**16 + 9), (100, 3, 299, 1), (700, 10**17, 700, 700)]:
        row = spark.range(1).select(collocations.cut_score(*(F.lit(v) for v in (a, n, left, right))).alias("s")).first()
        assert row.s == 1000 * a * n // (left * right)


def test_tables_mark_what_is_frequent(spark):
    texts = ["a b c. " * 9, "x y z. " * 4, "b c d"]
    docs = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    parsed = collocations.parse(docs, held_words=2)
    table = collocations._Bits(collocations._marked(parsed, [1], [], 9, 1 << 16, 3), 3)
    (packed,) = collocations.parse(spark.createDataFrame([("en", "a b c d x")], "lang string, text string")).collect()
    assert table.has(collocations._Chunks(*packed).phrase_hashes(1)).tolist() == [True, True, True, False, False]


# --- decontamination ----------------------------------------------------------
def leak_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def plain_leaks(docs, items, window):
    windows = defaultdict(set)
    for key, text in items:
        own = leak_words(text)
        size = min(window, len(own))
        for k in range(len(own) - size + 1 if own else 0):
            windows[tuple(own[k : k + size])].add(key)
    sizes = {len(w) for w in windows}
    for key, text in docs:
        own, hit, held = leak_words(text), set(), set()
        for size in sizes:
            for k in range(len(own) - size + 1):
                found = windows.get(tuple(own[k : k + size]))
                if found:
                    hit |= set(range(k, k + size))
                    held |= found
        names = sorted(str(i) for i in held if i is not None)
        yield key, len(own), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)


@pytest.fixture(scope="module")
def items(spark, odd):
    """Passages of the documents, items shorter than a window, repeats, and items without words, text or id."""
    long = odd.where("doc_id = 5").first().text.split()
    texts = [(10, " ".join(long[100:130])), (9, " ".join(long[120:150])), (9, " ".join(long[500:506])), (3, "The cat, sat!"), (4, "one")]
    texts += [(5, ""), (6, None), (7, " ... "), (8, "never seen words"), (None, " ".join(long[700:712])), (10, " ".join(long[100:130])), (11, "é Ü")]
    return spark.createDataFrame([(k, t, "x") for k, t in texts], "item_id long, text string, n_words string")


@pytest.mark.parametrize("options", [{}, {"block_bytes": 100}, {"shard_words": 50}, {"block_bytes": 1, "shard_words": 1000}])
def test_leaks(odd, items, options):
    want = sorted(plain_leaks([(r.doc_id, r.text) for r in odd.collect()], [(r.item_id, r.text) for r in items.collect()], 10), key=str)
    got = decontaminate.judge(odd, items, **options).collect()
    assert sorted((tuple(r) for r in got), key=str) == want
    assert 5 < sum(r[-1] for r in want) < len(want)
    kept = decontaminate.clean_documents(odd, items, **options)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in want if not r[-1])


def test_spans_are_the_hit_words(odd, items):
    for r in decontaminate.hits(odd, items, block_bytes=100).collect():
        ends = [(s.start, s.start + s.words) for s in r.spans]
        assert all(a[1] < b[0] for a, b in zip(ends, ends[1:], strict=False))


def test_longest_matches(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(60)))) for i in range(30)]
    items = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(12)))) for i in range(12)] + [(12, max((t for _, t in docs), key=len))]
    want = set()
    for key, text in docs:
        doc = leak_words(text)
        for item, own in ((i, leak_words(t)) for i, t in items):
            for k in range(len(doc)):
                for j in range(len(own)):
                    if k and j and doc[k - 1] == own[j - 1]:
                        continue
                    size = 0
                    while k + size < len(doc) and j + size < len(own) and doc[k + size] == own[j + size]:
                        size += 1
                    if size >= min(4, len(own)):
                        want.add((key, k, str(item), j, size))
    given = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for options in ({}, {"block_bytes": 30, "shard_words": 20}):
        got = [tuple(r) for r in decontaminate.matches(*given, window=4, **options).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert any(r[4] > 20 for r in want)


def test_leaks_of_nothing(odd, items, nothing):
    assert decontaminate.judge(nothing, items).count() == 0
    clean = decontaminate.judge(odd, items.where("item_id < 0"))
    assert clean.where("contaminated OR n_items > 0").count() == 0 and clean.count() == odd.count()


def test_suffix_array_is_sorted():
    import numpy as np

    rng = np.random.default_rng(4)
    for size in (1, 2, 50, 400):
        numbers = rng.integers(-1, 3, size).astype(np.int32)
        array = decontaminate.suffix_array(numbers, 8)
        assert sorted(array.tolist()) == np.flatnonzero(numbers >= 0).tolist()

        def head(at, numbers=numbers):
            own = numbers[at : at + 8].tolist()
            return own[: own.index(-1)] if -1 in own else own

        heads = [head(a) for a in array.tolist()]
        assert heads == sorted(heads)


# --- Merkle manifest ----------------------------------------------------------
def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(leaves, arity):
    """(root, proofs): for each leaf its (before, after) at each level."""
    proofs = [[] for _ in leaves]
    level, members = list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        runs = [range(k, min(k + arity, len(level))) for k in range(0, len(level), arity)]
        for run in runs:
            for k in run:
                segment = "".join(level[j] for j in run if j < k), "".join(level[j] for j in run if j > k)
                for i in members[k]:
                    proofs[i].append(segment)
        members = [[i for k in run for i in members[k]] for run in runs]
        level = [sha("".join(level[k] for k in run)) for run in runs]
    return (level[0] if level else None), proofs


def plain_leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_proofs(rows, arity=3):
    """Rows are (source, doc_id, leaf)."""
    groups = defaultdict(list)
    for source, key, leaf in rows:
        groups[source].append((key is not None, key, leaf))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (ordered := sorted(groups[s]), *plain_tree([leaf for *_, leaf in ordered], arity)) for s in names}
    root, upper = plain_tree([trees[s][1] for s in names], arity)
    for s, way in zip(names, upper, strict=True):
        ordered, subroot, proofs = trees[s]
        for (_, key, leaf), proof in zip(ordered, proofs, strict=True):
            yield key, leaf, subroot, root, tuple(proof + way)


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@pytest.mark.parametrize("arity", [2, 3])
def test_proofs(odd, arity):
    rows = odd.collect()
    want = Counter(plain_proofs([(r.source, r.doc_id, plain_leaf(*(r[c] for c in FIELDS))) for r in rows], arity))
    got = merkle.proofs(odd, merkle.digest_of(*FIELDS), arity=arity)
    found = got.withColumn("folded", merkle.folded(F.col("leaf"), F.col("proof"))).withColumn("sha", merkle.proof_digest(F.col("proof"))).collect()
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, tuple(map(tuple, r.proof))) for r in found) == want
    assert all(r.folded == r.root for r in found)
    assert all(r.sha == sha("".join(b + a for b, a in r.proof)) for r in found)


@pytest.mark.parametrize("sizes", [[1], [2], [3], [4], [9, 10], [1, 28, 2, 27, 1, 3, 8, 82, 1, 1], [250]])
def test_trees_of_all_heights(spark, sizes):
    rows = [(f"s{k:02}", i) for k, size in enumerate(sizes) for i in range(size)]
    docs = spark.createDataFrame(rows, "source string, doc_id long").repartition(7)
    want = set(plain_proofs([(s, i, plain_leaf(i, s)) for s, i in rows]))
    got = merkle.proofs(docs, merkle.digest_of("doc_id", "source")).collect()
    assert {(r.doc_id, r.leaf, r.subroot, r.root, tuple(map(tuple, r.proof))) for r in got} == want and len(got) == len(rows)


def test_proofs_of_nothing(nothing):
    assert merkle.proofs(nothing, merkle.digest_of(*FIELDS)).count() == 0


def test_a_large_group_is_numbered_by_many_tasks(spark):
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merge)
    spark.conf.set(merge, "false")
    try:
        docs = spark.range(10_000).selectExpr("'s' AS source", "id AS doc_id").repartition(3)
        ranked = merkle.numbered(docs, "source", ["doc_id"])
        assert ranked.where("place <> doc_id OR n <> 10000").count() == 0
        parts = docs.repartitionByRange("source", "doc_id").groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) > 1
    finally:
        spark.conf.set(merge, before)


# --- the queries --------------------------------------------------------------
@pytest.mark.parametrize("name", ["op11_collocations", "op12_decontamination", "op13_merkle"])
def test_queries_against_sql(spark, name):
    base = duckdb.connect()
    for table in ("documents", "benchmark"):
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want = base.execute(LLM_ORACLES[name])
    columns = [c[0] for c in want.description]
    got = LLM_QUERIES[name](spark, SF)
    assert got.columns == columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)


def test_tampering_is_found(spark):
    rows = LLM_QUERIES["op13_merkle"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    import zlib

    for r in rows:
        changed = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (texts[r.doc_id] or "")
        assert r.verified != changed and (r.folded_root == r.root) == r.verified
    assert {r.verified for r in rows} == {True, False}
