"""Lexical search, Merkle manifest and mixing, against brute force, SQL and odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from conftest import DATA
from harness import difference, duck
from hypothesis import given, settings
from hypothesis import strategies as st

from terrella.llm import common, lexical, manifest, mixing, queries

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, size int, position int, n int"
ODD = [
    (None, "nobody knows this one", None, None, None),
    (None, "nobody knows this one", None, None, None),
    (None, None, None, None, None),
    (1, None, "en", "a", None),
    (2, "", "en", "a", 0),
    (3, " \n\t\x0b ", "", "", 3),
    (4, "Zebra ZEBRA zebra-crossing über ÜBER 漢字 42", "en", "b", 44),
    (5, "zebra crossing", "en", "b", 14),
    (5, "zebra crossing", "en", "b", 14),
    (5, "crossing zebra", "en", "b", 14),
    (6, "zebra crossing", "de", "B", 9223372036854775807),
    (7, "word " * 30_000, "en", "long", 150_000),
    (8, "😀" * 50 + " :: ", "de", "é", 54),
]


@pytest.fixture(scope="module")
def docs(spark):
    return common.prepare(spark).read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(*r, "leaf", 1, 2, 3) for r in ODD]
    return common.prepare(spark).createDataFrame(rows, SCHEMA).repartition(3)


def rows_of(frame):
    return [r.asDict() for r in frame.select("doc_id", "text", "lang", "source", "n_chars").collect()]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_match_sql(spark, seven_parts, name):
    assert difference(spark, seven_parts, queries.queries()[name], queries.oracle_sql()[name], duck(DATA)) is None


# Ranked lexical search


def terms(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))


def searched(rows, items, k=10):
    found = [(r["doc_id"], Counter(terms(r["text"]))) for r in rows]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    total, length = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * x + 1))) for t, x in df.items()}
    out = []
    for item, text in items:
        scored = []
        for i, counts, n in found:
            m = 10 + 90 * n * total // length
            score = sum(weight[t] * (10**9 * counts[t] // (1000 * counts[t] + 8 * m)) for t in set(terms(text)) if t in counts)
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        scored.sort(key=lambda s: s[:3])
        out += [(item, rank + 1, s[3], -s[0]) for rank, s in enumerate(scored[:k])]
    return out


@pytest.mark.parametrize("batch", [1, 7, 16_384])
def test_search_matches_brute_force(spark, docs, odd, monkeypatch, batch):
    monkeypatch.setattr(lexical, "BATCH_DOCS", batch)
    both = docs.select("doc_id", "text").union(odd.select("doc_id", "text"))
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()][:20]
    items += [(None, "zebra"), (900, "Zebra über crossing, word!"), (900, "word"), (901, None), (902, ""), (903, "unheard-of1")]
    benchmark = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id bigint, text string, rank string, score int")
    got = lexical.search(both.repartition(5), benchmark)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = searched([r.asDict() for r in both.collect()], items)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_search_in_blocks_of_queries_finds_the_same(spark, docs, monkeypatch):
    benchmark = spark.read.parquet(f"{DATA}/benchmark.parquet")
    want = sorted(map(tuple, lexical.search(docs, benchmark).collect()))
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 3000)
    assert sorted(map(tuple, lexical.search(docs, benchmark).collect())) == want


def test_search_of_nothing_finds_nothing(spark, odd):
    benchmark = spark.createDataFrame([(1, "zebra")], "item_id bigint, text string")
    for docs, items in ((odd.limit(0), benchmark), (odd, benchmark.limit(0)), (odd.filter("text is null"), benchmark)):
        found = lexical.search(docs, items)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40), st.lists(st.lists(st.integers(0, 39), max_size=30), min_size=1, max_size=12), st.integers(1, 5), st.data())
def test_limited_accumulators_lose_no_document(size, postings, k, data):
    lists, query = {}, []
    for word, places in enumerate(postings):
        places = np.array(sorted({p for p in places if p < size}), np.int64)
        factors = np.array([data.draw(st.integers(1, 9)) for _ in places], np.int64)
        lists[word] = (places, factors)
        weight = data.draw(st.integers(0, 20))
        query.append((word, weight, weight * int(factors.max(initial=0))))
    query.sort(key=lambda q: len(lists[q[0]][0]))
    exact = np.zeros(size, np.int64)
    for word, weight, _ in query:
        exact[lists[word][0]] += weight * lists[word][1]
    bar = data.draw(st.integers(1, 200))
    found, scores = lexical.accumulate(query, lists, size, bar, k)
    assert (scores == exact[found]).all()
    must = sorted(exact[exact >= bar], reverse=True)[:k]
    kept = set(found.tolist())
    # All that reach both the bar and the k-th best score, ties included, are there.
    assert {i for i in range(size) if must and exact[i] >= must[-1]} <= kept


def test_few_accumulators_are_made_after_a_good_batch():
    rare, common_ = (np.array([3]), np.array([100])), (np.arange(1000), np.ones(1000, np.int64))
    query = [(0, 50, 5000), (1, 1, 1)]
    found, scores = lexical.accumulate(query, {0: rare, 1: common_}, 1000, bar=2, k=10)
    assert found.tolist() == [3] and scores.tolist() == [5001]


# Merkle manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    parts = []
    for name in manifest.FIELDS:
        value = row[name]
        if value is not None:
            value = str(value + more if name == "n_chars" else value)
        parts.append("-" if value is None else f"{len(value.encode())}:{value}")
    return H(*parts)


def tree(nodes):
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            other = a ^ 1
            paths[i].append((other < a, nodes[other] if other < len(nodes) else None))
            at[i] = a // 2
        nodes = [H(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def manifested(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r["lang"], []).append(r)
    names = sorted(langs, key=lambda n: (n is not None, (n or "").encode()))
    trees = {}
    for name in names:
        members = sorted(langs[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[name] = (members, *tree([leaf(r) for r in members]))
    root, higher = tree([trees[n][1] for n in names])
    for name, above in zip(names, higher):
        members, subroot, paths = trees[name]
        for r, own in zip(members, paths):
            path = own + above
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None
            folded = leaf(r, int(hit))
            for left, other in path:
                folded = H(folded) if other is None else H(other, folded) if left else H(folded, other)
            yield r["doc_id"], leaf(r), subroot, root, H(*[o for _, o in path if o]), folded, folded == root


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_manifest_matches_brute_force(docs, odd):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    for frame in (odd, docs.select(names).union(odd.select(names)).repartition(5)):
        got = manifest.manifest_digest(frame)
        assert got.columns == COLUMNS
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(manifested(rows_of(frame)), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 8])
@pytest.mark.parametrize("sizes", [(1,), (2, 1), (3, 4, 5, 1, 1), (257, 16, 17), (520, 1)])
def test_trees_of_every_shape(spark, monkeypatch, levels, sizes):
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", levels)
    monkeypatch.setattr(manifest, "BLOCK", 1 << levels)
    if levels < 8 and sum(sizes) > 100:
        sizes = tuple(min(s, 33) for s in sizes)
    rows = [(100 * i + j, f"l{i}", "s", j, "text") for i, n in enumerate(sizes) for j in range(n)]
    frame = spark.createDataFrame(rows, "doc_id bigint, lang string, source string, n_chars bigint, text string")
    got = manifest.manifest_digest(frame).collect()
    assert sorted(map(tuple, got)) == sorted(manifested(rows_of(frame)))


def test_manifest_numbers_and_paths(odd):
    found = manifest.manifest(odd).collect()
    by_lang = {}
    for r in found:
        by_lang.setdefault(r["lang"], []).append(r["position"])
    assert all(sorted(p) == list(range(len(p))) for p in by_lang.values()) and len(by_lang) == 4
    for r in found:
        assert all(not (s["left"] and s["right"]) for s in r["path"])
        node = r["leaf"]
        for s in r["path"]:
            node = H(s["left"], node, s["right"])
        assert node == r["root"]


def test_manifest_of_nothing_is_empty(odd):
    assert manifest.manifest_digest(odd.limit(0)).count() == 0


# Mixing


def mixed(rows, seed=13, weights=(5, 2, 1), repeats=3):
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += size(r)
    names = sorted(sizes, key=lambda n: (n is None, n or ""))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [n for n in names if n not in full]
        level = Fraction(total - sum(repeats * sizes[n] for n in full), sum(weight[n] for n in free) or 1)
        above = {n for n in free if weight[n] * level > repeats * sizes[n]}
        if not above:
            break
        full |= above
    for name in names:
        target = repeats * sizes[name] if name in full else weight[name] * level
        goal = int(target + Fraction(1, 2))
        passes = goal // sizes[name] if sizes[name] else 0
        rest = goal - passes * sizes[name]

        def place(r):
            content = hashlib.md5((r["text"] or "").encode()).hexdigest()
            drawn = hashlib.md5(f"{seed}-{'' if r['doc_id'] is None else r['doc_id']}-{content}".encode()).hexdigest()
            return int(drawn[:15], 16), r["doc_id"] or 0, content

        for r in sorted((r for r in rows if r["source"] == name), key=place):
            part = max(0, min(rest, size(r)))
            rest -= size(r)
            yield r["doc_id"], size(r), sizes[name], float(target), passes * size(r) + part


def test_mix_matches_brute_force(docs, odd):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    for frame in (odd, docs.select(names).union(odd.select(names)).repartition(5)):
        got = mixing.mix_digest(frame)
        assert got.columns == ["doc_id", "size", "source_size", "target", "taken", "first_position"]
        assert sorted(map(tuple, got.drop("first_position").collect()), key=repr) == sorted(mixed(rows_of(frame)), key=repr)
        assert got.filter("(taken > 0) != (first_position is not null)").count() == 0


def test_taken_words_meet_the_targets(docs):
    wanted = {r[0]: r for r in docs.select("doc_id", "source").collect()}
    taken, target = Counter(), {}
    for r in mixing.mix_digest(docs).collect():
        source = wanted[r["doc_id"]]["source"]
        taken[source] += r["taken"]
        target[source] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in target)


def test_the_training_sequence_follows_the_schedules(docs, odd):
    entries = mixing.mix(docs, carry=["text"]).orderBy("position").collect()
    at, end = 0.0, 0
    for e in entries:
        assert e["position"] == end and e["at"] >= at and 0 <= e["at"] <= 1 and e["words"] > 0
        assert e["words"] <= len(re.findall(r"[^\x20\x09-\x0D]+", e["text"]))
        at, end = e["at"], end + e["words"]
    assert end == sum(e["words"] for e in entries)
    # Sources of the falling schedule lead in the first half, those of the rising one in the second.
    names = sorted({e["source"] for e in entries})
    early = Counter()
    for e in entries:
        early[names.index(e["source"]) % 3, e["at"] < 0.5] += e["words"]
    share = [early[i, True] / (early[i, True] + early[i, False]) for i in range(3)]
    assert abs(share[0] - 0.625) < 0.05 and abs(share[1] - 0.5) < 0.05 and abs(share[2] - 0.375) < 0.05


def test_reruns_and_layouts_agree(docs):
    one = sorted(map(tuple, mixing.mix_digest(docs).collect()))
    assert one == sorted(map(tuple, mixing.mix_digest(docs.repartition(9)).collect()))
    assert one != sorted(map(tuple, mixing.mix_digest(docs, seed=14).collect()))


def test_a_moment_inverts_the_integral(spark):
    from pyspark.sql import functions as F

    schedule = ((0.0, 0.0), (0.25, 4.0), (0.5, 0.0), (0.75, 0.0), (1.0, 2.0))
    total, stretches = mixing.integrated(schedule)
    assert total == pytest.approx(1.25)
    column = F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(s, ("start", "weight", "slope", "before"))]) for s in stretches])
    shares = [i / 50 for i in range(51)]
    frame = spark.createDataFrame([(s,) for s in shares], "share double")
    moments = [r["m"] for r in frame.select("share", mixing.moment(F.col("share"), column, F.lit(total)).alias("m")).orderBy("share").collect()]
    for share, m in zip(shares, moments):
        done = np.interp(np.linspace(0, m, 20_001), *zip(*schedule))
        assert np.trapezoid(done, dx=m / 20_000) == pytest.approx(share * total, abs=1e-4)
    for bad in (((0.0, 1.0),), ((0.0, 1.0), (0.9, 1.0)), ((0.0, -1.0), (1.0, 2.0)), ((0.0, 0.0), (1.0, 0.0))):
        with pytest.raises(ValueError):
            mixing.integrated(bad)


def test_mix_of_nothing_is_empty(odd):
    assert mixing.mix_digest(odd.limit(0)).count() == 0
    nothing = mixing.mix_digest(odd.filter("text is null")).collect()
    assert len(nothing) == 2 and all(r["taken"] == 0 and r["target"] == 0 for r in nothing)
