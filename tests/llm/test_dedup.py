"""Substring, byte-string and near-duplicate removal against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_corpus import docs, nothing, rows  # noqa: F401

from seqloom.llm import jaccard, licenses, repeats, substrings, suffixes
from seqloom.llm import tokens as T
from seqloom.llm.components import components
from seqloom.llm.recompression import range_minimum, recompress
from seqloom.llm.store import REST


def removed(units, size):
    """For each text, which units lie in a window that occurs more than once anywhere."""
    seen = Counter(tuple(u[i : i + size]) for u in units for i in range(len(u) - size + 1))
    out = []
    for u in units:
        gone = [False] * len(u)
        for i in range(len(u) - size + 1):
            if seen[tuple(u[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        out.append(gone)
    return out


def found(frame):
    return {r[REST]["doc_id"]: r for r in frame.collect()}


@pytest.mark.parametrize("size", [5, 35])
def test_substrings_match_brute_force(docs, rows, size):
    got = found(substrings.dedup_substrings(docs, size))
    units = [(t or "").encode().split() for _, t, _, _ in rows]
    for (doc_id, *_), words, gone in zip(rows, units, removed(units, size), strict=True):
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        assert (got[doc_id]["_n_units"], got[doc_id]["_n_removed"], got[doc_id]["_kept"]) == (len(words), sum(gone), kept)
        assert got[doc_id][REST]["_row"] == doc_id * 10


@pytest.mark.parametrize("seed", range(3))
def test_substrings_of_few_words(spark, tmp_path, seed):
    """Few different words: runs, periods and overlaps everywhere."""
    rng = random.Random(seed)
    texts = [[rng.choice("ab" if i % 2 else "abcde") for _ in range(rng.randint(0, 60))] for i in range(30)]
    spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id LONG, text STRING").write.parquet(str(tmp_path / "t"))
    got = found(substrings.dedup_substrings(spark.read.parquet(str(tmp_path / "t")), 8))
    assert [got[i]["_n_removed"] for i in range(30)] == [sum(g) for g in removed(texts, 8)]


def test_substrings_named_in_spark_rounds(docs, rows, spark, tmp_path):
    """Dictionaries of the whole corpus lead to the same repeats as hashes do."""
    plain, rounds = found(substrings.dedup_substrings(docs, 5)), found(substrings.dedup_substrings(docs, 5, in_rounds=True))
    assert {i: r["_kept"] for i, r in plain.items()} == {i: r["_kept"] for i, r in rounds.items()}
    rng = random.Random(9)
    texts = [[rng.choice("ab" if i % 2 else "abcde") for _ in range(rng.randint(0, 60))] for i in range(30)]
    spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id LONG, text STRING").write.parquet(str(tmp_path / "t"))
    got = found(substrings.dedup_substrings(spark.read.parquet(str(tmp_path / "t")), 8, in_rounds=True))
    assert [got[i]["_n_removed"] for i in range(30)] == [sum(g) for g in removed(texts, 8)]


@pytest.mark.parametrize("size", [20, 200])
def test_bytes_match_brute_force(docs, rows, size):
    got = found(suffixes.dedup_bytes(docs, size))
    units = [(t or "").encode() for _, t, _, _ in rows]
    for (doc_id, *_), raw, gone in zip(rows, units, removed(units, size), strict=True):
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        r = got[doc_id]
        assert (r["_n_units"], r["_n_removed"], r["_n_spans"], bytes(r["_kept"])) == (len(raw), sum(gone), spans, kept)


def test_anchors_dealt_over_tasks_agree(docs, monkeypatch):
    whole = {i: r["_n_removed"] for i, r in found(suffixes.dedup_bytes(docs, 20)).items()}
    monkeypatch.setattr(suffixes, "TOGETHER", 1)
    assert {i: r["_n_removed"] for i, r in found(suffixes.dedup_bytes(docs, 20)).items()} == whole


def test_nothing_to_remove(nothing):
    assert substrings.dedup_substrings(nothing).collect() == []
    assert suffixes.dedup_bytes(nothing).collect() == []


def test_deep_shallow_orders_like_python():
    rng = random.Random(5)
    text = np.frombuffer(bytes(rng.choice(b"ab") for _ in range(1500)), np.uint8)
    starts, group = np.arange(1400), np.array([rng.randrange(3) for _ in range(1400)])
    for depth, shallow in ((20, 8), (13, 64), (100, 16)):
        rank = suffixes.deep_shallow(text, starts, group, depth, shallow)
        keys = [(g, text[s : s + depth].tobytes()) for s, g in zip(starts, group, strict=True)]
        first = {}
        for place, key in enumerate(sorted(keys)):
            first.setdefault(key, place)
        assert rank.tolist() == [first[k] for k in keys]


def test_blind_trie_orders_like_python():
    rng = random.Random(6)
    strings = [bytes(rng.choice(b"abc") for _ in range(9)) for _ in range(400)]
    classes = suffixes.blind_trie(strings)
    assert [sorted({strings[i] for i in c}) for c in classes] == [[s] for s in sorted(set(strings))]
    assert blind_empty() == []


def blind_empty():
    return suffixes.blind_trie([])


def test_equal_windows_hold_equal_symbols():
    """Whatever stands around a passage, a window of it holds the same symbols at the same places."""
    rng = np.random.default_rng(1)
    passage = rng.integers(0, 50, 60).astype(np.uint64)
    texts = [np.concatenate([rng.integers(0, 50, k).astype(np.uint64), passage, rng.integers(0, 50, 9).astype(np.uint64)]) for k in (0, 7, 31)]
    held = []
    for t, k in zip(texts, (0, 7, 31), strict=True):
        s = recompress(t, np.array([0, len(t)]))
        inside = (s.low >= k + 10) & (s.high <= k + 45)
        held.append(list(zip(s.name[inside].tolist(), (s.start[inside] - k).tolist(), strict=True)))
    assert held[0] and held[0] == held[1] == held[2]


def test_range_minimum():
    values = np.array([5, 3, 8, 1, 9, 2])
    first, last = np.array([0, 2, 4, 0]), np.array([2, 5, 6, 6])
    assert range_minimum(values, first, last).tolist() == [3, 1, 2, 1]


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def linked(sets):
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            same = len(sets[a] & sets[b])
            if same and 100 * same >= 75 * (len(sets[a]) + len(sets[b]) - same):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def test_near_duplicates_match_brute_force(docs, rows, nothing):
    got = {r.doc_id: r for r in jaccard.near_duplicates(docs).collect()}
    sets = [shingles(t) for _, t, _, _ in rows]
    assert [got[i].n_shingles for i in range(len(rows))] == [len(s) for s in sets]
    assert [got[i].component_id for i in range(len(rows))] == linked(sets)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    roots = linked(sets)
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(len(rows)) if roots[i] == i]
    assert jaccard.near_duplicates(nothing).collect() == []


@pytest.mark.parametrize("hub_rounds", [0, 2])
def test_near_duplicates_in_chains(spark, tmp_path, hub_rounds):
    """Chains of edits: the ends are not similar, but connected; and sizes around the threshold."""
    rng = random.Random(3)
    texts = []
    for _ in range(4):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(8, 60))]
        for _ in range(9):
            texts.append(" ".join(words))
            words = list(words)
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
            if rng.random() < 0.4:
                words = words[: rng.randint(max(6, len(words) - 4), len(words))]
    rng.shuffle(texts)
    path = str(tmp_path / "t")
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id LONG, text STRING").write.parquet(path)
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.read.parquet(path), hub_rounds).collect()}
    assert [got[i] for i in range(len(texts))] == linked([shingles(t) for t in texts])


def test_prefixes_of_similar_sets_share_what_is_asked():
    rng = np.random.default_rng(4)
    known = np.unique(rng.integers(0, 2**63, 4000, dtype=np.uint64))
    hits = jaccard.Common(known, rng.integers(2, 2000, len(known)))
    for _ in range(300):
        common = rng.integers(0, 2**63, rng.integers(3, 200), dtype=np.uint64)
        common = np.unique(np.concatenate([common, rng.choice(known, rng.integers(0, 60))]))
        a = np.unique(np.concatenate([common, rng.integers(0, 2**63, rng.integers(0, len(common) // 6 + 1), dtype=np.uint64)]))
        b = np.unique(np.concatenate([common, rng.integers(0, 2**63, rng.integers(0, len(common) // 6 + 1), dtype=np.uint64)]))
        same = len(np.intersect1d(a, b))
        if 100 * same < 75 * (len(a) + len(b) - same):
            continue
        (pa, _, ka, _), (pb, _, kb, _) = (jaccard.ordered_prefixes(v, np.array([0, len(v)]), hits) for v in (a, b))
        ka, kb = int(ka[0]), int(kb[0])
        matches = len(np.intersect1d(pa, pb))
        left = max(-(-75 * len(a) // 100) - ka, -(-75 * len(b) // 100) - kb)
        assert matches >= min(ka, kb) and matches + left >= -(-75 * (len(a) + len(b)) // 175)


def test_sketches_never_rule_out_a_link(spark):
    rng = np.random.default_rng(8)
    rows, pairs, linked_pairs = [], [], set()
    for i in range(0, 400, 2):
        common = rng.integers(0, 2**63, rng.integers(1, 300 if i % 40 else 4000), dtype=np.uint64)
        both = [np.unique(np.concatenate([common, rng.integers(0, 2**63, rng.integers(0, len(common) // 3 + 2), dtype=np.uint64)])) for _ in "ab"]
        for j, values in enumerate(both):
            longs = jaccard.sketches(values, np.array([0, len(values)]))[0].as_py()
            rows.append((i + j, len(values), longs))
        same = len(np.intersect1d(*both))
        pairs.append((i, i + 1))
        if 100 * same >= 75 * (len(both[0]) + len(both[1]) - same):
            linked_pairs.add((i, i + 1))
    known = spark.createDataFrame(rows, "node LONG, n LONG, sketch ARRAY<LONG>")
    left = {(r.a, r.b) for r in jaccard.possible(spark.createDataFrame(pairs, "a LONG, b LONG"), known).collect()}
    assert linked_pairs <= left and len(left) < len(linked_pairs) + (len(pairs) - len(linked_pairs)) / 2


def test_remaining_pairs_are_counted_a_row_a_pair(spark):
    """Two sets share a whole prefix, a third only one shingle with them; no join makes a row a match."""
    held = [(t, node, t) for node in (1, 2) for t in range(6)] + [(0, 3, 0), *[(100 + t, 3, t) for t in range(1, 6)]]
    rows = spark.createDataFrame([(t, node, 20, 1, place, 6, 0, node) for t, node, place in held],
                                 "token LONG, node LONG, n INT, k BYTE, place INT, held LONG, rank INT, label LONG")
    known = spark.createDataFrame([(node, 20, [-1] * 16) for node in (1, 2, 3)], "node LONG, n LONG, sketch ARRAY<LONG>")
    pairs = jaccard._remaining_pairs(rows, known)
    assert [(r.a, r.b) for r in pairs.collect()] == [(1, 2)]
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "token#" not in "".join(line for line in plan.splitlines() if "Join" in line)


def test_components(spark):
    for seed in range(2):
        rng = random.Random(seed)
        links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(25)]
        parent = defaultdict(lambda: None)

        def find(x, parent=parent):
            while parent[x] is not None:
                x = parent[x]
            return x

        for a, b in links:
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
        got = {r.node: r.root for r in components(spark.createDataFrame(links, "a LONG, b LONG")).collect()}
        nodes = {n for link in links for n in link}
        assert {n: got.get(n, n) for n in nodes} == {n: find(n) for n in nodes}


def test_components_of_a_node_between_two_roots(spark):
    """After one round 5 and 6 hang on 1 and on 2, and neither root is below another node."""
    links = spark.createDataFrame([(1, 5), (5, 6), (6, 7), (7, 2)], "a LONG, b LONG")
    got = sorted((r.node, r.root) for r in components(links).collect())
    assert got == [(2, 1), (5, 1), (6, 1), (7, 1)]


@pytest.mark.parametrize("seed", range(3))
def test_components_of_short_chains(spark, seed):
    """Chains whose ids are in any order: every node once, on its chain's least."""
    rng = random.Random(seed)
    ids = rng.sample(range(10**6), 600)
    links, least, at = [], {}, 0
    while at < len(ids):
        chain = ids[at : at + rng.randint(2, 9)]
        links += zip(chain[:-1], chain[1:], strict=True)
        least.update(dict.fromkeys(chain, min(chain)))
        at += len(chain)
    got = [(r.node, r.root) for r in components(spark.createDataFrame(links, "a LONG, b LONG")).collect()]
    assert sorted(got) == sorted((n, m) for n, m in least.items() if n != m)


@pytest.fixture
def other_splits(spark, monkeypatch):
    """Scans are split otherwise after every stored table, as when executors come and go."""
    names = ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")
    turns = []

    def turn():
        turns.append(1)
        spark.conf.set(names[0], str(2 + len(turns) % 2))

    spark.conf.set(names[1], "1")
    turn()
    for module in (jaccard, licenses, repeats):
        for name in {"store", "settled"} & set(vars(module)):

            def turned(*given, plain=getattr(module, name)):
                out = plain(*given)
                turn()
                return out

            monkeypatch.setattr(module, name, turned)
    yield turn
    for name in names:
        spark.conf.unset(name)


def test_rows_keep_their_names_however_scans_are_split(spark, docs, rows, other_splits, tmp_path):
    path = str(tmp_path / "one")
    docs.coalesce(1).write.parquet(path)
    stored = spark.read.parquet(path)
    named = []
    for _ in range(2):
        named.append({r.doc_id: r._row for r in jaccard.near_duplicates(stored).collect()})
        other_splits()
    assert named[0] == named[1] and len(set(named[0].values())) == len(rows)
    roots = linked([shingles(t) for _, t, _, _ in rows])
    assert sorted(r.doc_id for r in jaccard.keep_one(stored).collect()) == [i for i in range(len(rows)) if roots[i] == i]
    got = found(substrings.dedup_substrings(stored, 5))
    gone = removed([(t or "").encode().split() for _, t, _, _ in rows], 5)
    assert [got[i]["_n_removed"] for i in range(len(rows))] == [sum(g) for g in gone]
    files = stored.selectExpr("doc_id", "concat('a/', doc_id) AS path", "text")
    told = {r.doc_id: r.own_license for r in licenses.scan_licences(files).collect()}
    assert {i for i, name in told.items() if name == "MIT"} == {i for i, t, _, _ in rows if "MIT License" in (t or "")}


def test_rows_of_a_frame_that_is_no_table(spark, rows):
    frame = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id LONG, text STRING")
    roots = linked([shingles(t) for _, t, _, _ in rows])
    assert sorted(r.doc_id for r in jaccard.keep_one(frame).collect()) == [i for i in range(len(rows)) if roots[i] == i]


def test_words_split_like_bytes():
    data = b"a\x0bb \xc3\xa9\x0c c\x1cd\r\n\te" + b"  " + b"f"
    starts, ends, offsets = T.words(np.frombuffer(data, np.uint8), np.array([0, 4, 4, len(data)]))
    got = [data[s:e] for s, e in zip(starts, ends, strict=True)]
    assert got == data[:4].split() + data[4:].split() and offsets.tolist() == [0, 2, 2, len(got)]


def test_kept_rows_are_never_broadcast(docs):
    plan = jaccard.keep_one(docs)._jdf.queryExecution().executedPlan().toString()
    semi = [line for line in plan.splitlines() if "LeftSemi" in line]
    assert semi and all("SortMergeJoin" in line for line in semi)


def test_short_lists_are_not_summed_up_before_they_travel(spark, monkeypatch):
    """Lists of shingles with few hits travel as rows; dealt out or not, the same pairs come of them."""
    kept = {}

    def store(frame, label, write=jaccard.store):
        kept[label] = write(frame, label)
        return kept[label]

    monkeypatch.setattr(jaccard, "store", store)
    # two sets share four shingles; a third one shares one with them, a fourth is alone in its list
    lists = [(t, v) for t in range(4) for v in (10, 20)] + [(3, 30), (9, 40)]
    found = {}
    for dealt in (False, True):
        rows = [(t, v, 1 + v % 7 if dealt else 0, 8, 2, 0, 4, -16, v) for t, v in lists]
        rows = spark.createDataFrame(rows, "token LONG, node LONG, salt INT, n INT, k BYTE, place INT, held LONG, rank INT, label LONG")
        found[dealt] = sorted(tuple(r) for r in jaccard._hub_pairs(rows, 0).collect())
        assert kept["lists"].count() == (4 if dealt else 0)
    assert found[False] == found[True] == [(10, 20)]
