"""Language-model scores, URL verdicts, licences, packing and the pipeline."""

import math
import os
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_corpus import docs, nothing, rows  # noqa: F401
from public_tokenizers import path as tokenizer_path

from seqloom.llm import jaccard, licenses, lm, packing, substrings, urls
from seqloom.llm import tokens as T
from seqloom.llm.store import REST, number_rows

TOKENIZER = tokenizer_path("word_bpe_49k.json")


def lm_words(text):
    words = []
    for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split():
        for _ in range(2):
            if len(w) > 1 and w[-1:] in (b".", b",", b";", b":", b"!", b"?"):
                w = w[:-1]
        words.append(w)
    return words


def brute_losses(texts, target, background):
    """Interpolated bigram losses by dictionaries; small corpora keep every word and bigram seen twice."""
    counts = [Counter(w for t in c for w in lm_words(t)) for c in (target, background)]
    vocabulary = {w for w, n in counts[1].items() if n >= 2}
    known = lambda w: w if w in vocabulary else None
    pairs = [Counter(p for t in c for p in zip(["<s>"] + [known(w) for w in lm_words(t)], [known(w) for w in lm_words(t)], strict=False)) for c in (target, background)]
    kept = {p for p, n in pairs[1].items() if n >= 2}
    out = []
    for m in (0, 1):
        total = sum(counts[m].values())
        uni = defaultdict(int)
        for w, n in counts[m].items():
            uni[known(w)] += n
        uni_p = {w: (uni[w] + 1) / (total + len(vocabulary) + 1) for w in [*vocabulary, None]}
        uni["<s>"] = sum(n for (h, _), n in pairs[m].items() if h == "<s>")
        part = {p: lm.INTERPOLATION * pairs[m][p] / uni[p[0]] if uni[p[0]] else 0.0 for p in kept}
        mass = defaultdict(float)
        for (h, _), p in part.items():
            mass[h] += p
        losses = []
        for t in texts:
            ids = [known(w) for w in lm_words(t)]
            each = [-math.log(part.get(p, 0.0) + max(1 - mass[p[0]], 1e-6) * uni_p[p[1]]) for p in zip(["<s>", *ids], ids, strict=False)]
            losses.append(sum(each) / len(each) if each else None)
        out.append(losses)
    return out


def test_lm_scores_match_brute_force(spark, docs, rows, nothing):
    labels = spark.createDataFrame([(i, int(i % 2 == 0), int(i % 8 == 0)) for i in range(0, 30)] + [(2, 1, 0), (None, 1, 0)],
                                   "doc_id LONG, quality INT, toxic INT")
    target = lm.labelled_target(docs, labels)
    good = [t for i, t, _, _ in rows if i < 30 and i % 2 == 0 and i % 8]
    assert sorted(r.text or "" for r in target.collect()) == sorted(t or "" for t in good)
    got = {r.doc_id: r for r in lm.cross_entropy_difference(docs, target).collect()}
    texts = [t for _, t, _, _ in rows]
    for i, (t_loss, b_loss) in enumerate(zip(*brute_losses(texts, good, texts), strict=True)):
        assert got[i].n_words == len(lm_words(texts[i]))
        if t_loss is None:
            assert got[i].target_loss is None and got[i].score is None
        else:
            assert got[i].target_loss == pytest.approx(t_loss) and got[i].background_loss == pytest.approx(b_loss)
            assert got[i].score == pytest.approx(t_loss - b_loss)
    assert lm.cross_entropy_difference(nothing, nothing).collect() == []


def test_lm_scores_count_rare_words_at_every_size(spark, tmp_path):
    """In a corpus of 2.2 million words, a word and a bigram seen twice are still known."""
    texts = ["filler word " * 550_000, "filler word " * 550_000, "quixotry zephyr of the lantern", "the quixotry zephyr", None]
    rare = [(i, x) for i, x in enumerate(texts)]
    spark.createDataFrame(rare, "doc_id LONG, text STRING").write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    target = stored.where("doc_id = 3").select("text")
    got = {r.doc_id: r for r in lm.cross_entropy_difference(stored, target).collect()}
    want = brute_losses([texts[3]], [texts[3]], texts)
    assert (got[3].target_loss, got[3].background_loss) == (pytest.approx(want[0][0]), pytest.approx(want[1][0]))
    assert len(got) == 5 and got[4].score is None


def prose(seed, texts, words, vocabulary=3000):
    """Texts whose bigrams are nearly all different, as in a large corpus."""
    rng = random.Random(seed)
    names = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(vocabulary)]
    return [" ".join(rng.choices(names, k=words)) for _ in range(texts)]


def stored_texts(spark, path, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").write.parquet(path)
    return spark.read.parquet(path)


def test_lm_scores_store_few_bytes_for_each_bigram(spark, tmp_path, monkeypatch):
    """Names that were stored took 8 bytes and more for each different bigram of a block, beside their counts."""
    texts = prose(1, 300, 300)
    stored = stored_texts(spark, str(tmp_path / "d"), texts)
    sizes, store = [], lm.store

    def measured(frame, label):
        made = store(frame, label)
        sizes.append(sum(os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for f in made.inputFiles()))
        return made

    monkeypatch.setattr(lm, "store", measured)
    lm.cross_entropy_difference(stored, stored.where("doc_id % 2 = 0").select("text"))
    different = len({p for t in texts for p in zip(t.split(), t.split()[1:], strict=False)})
    assert different > 85_000 and sum(sizes) < 8 * different


@pytest.mark.parametrize("with_background", [False, True])
def test_lm_scores_match_brute_force_over_many_blocks(spark, tmp_path, monkeypatch, with_background):
    """Blocks of a few rows, texts that are blocks of their own, many parts, and corpora that share only some words."""
    monkeypatch.setattr(lm, "TIERS", ((200, 2), (500, 1)))
    monkeypatch.setattr(lm, "LEAST_PART_BITS", 6)
    some, other = prose(2, 30, 25, 60), prose(2, 45, 25, 60)[30:] + prose(3, 10, 12, 40)
    texts = [*some, " ".join(some[:4]), " ".join(some[4:14]), "", None, " \n", "A. a, a! A", "only here", *some[:2]]
    target = [*some[::3], *other[:3], None, "", "a a only"]
    background = [*other, *some[10:20], None, "a only here only"] if with_background else None
    got = lm.cross_entropy_difference(
        stored_texts(spark, str(tmp_path / "d"), texts),
        stored_texts(spark, str(tmp_path / "t"), target).select("text"),
        stored_texts(spark, str(tmp_path / "b"), background).select("text") if with_background else None,
    )
    got = {r.doc_id: r for r in got.collect()}
    assert len(got) == len(texts)
    for i, (t_loss, b_loss) in enumerate(zip(*brute_losses(texts, target, background or texts), strict=True)):
        assert got[i].n_words == len(lm_words(texts[i]))
        assert (got[i].target_loss, got[i].background_loss) == ((None, None) if t_loss is None else (pytest.approx(t_loss), pytest.approx(b_loss)))


@pytest.mark.parametrize("width", [7, 12, 41, 64])
def test_bigram_names_are_one_to_one(width):
    x = np.concatenate([np.arange(100, dtype=np.uint64), np.uint64((1 << width) - 1) - np.arange(28, dtype=np.uint64)])
    names = lm.scrambled(x, width)
    assert int(names.max()) < 1 << width and (lm.unscrambled(names, width) == x).all()
    base = int(names.min())
    assert (lm.unpack_sorted(lm.pack_sorted(np.sort(names), base), base) == np.sort(names)).all()
    assert (lm.unpack(lm.pack(names)) == names).all() and not len(lm.unpack(lm.pack(names[:0])))


def test_lm_scores_tell_held_out_labels_apart(spark):
    sf = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    train = labels.where("doc_id % 2 = 0")
    scored = lm.cross_entropy_difference(documents, lm.labelled_target(documents, train))
    held = scored.join(labels.where("doc_id % 2 = 1"), "doc_id").where("score IS NOT NULL").collect()
    good = [r.score for r in held if r.quality == 1 and r.toxic == 0]
    bad = [r.score for r in held if r.quality == 0]
    above = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    assert above > 0.9


URLS = [
    "http://www.example.com/en/x?y#z", "https://shop.example.com/en/a", "http://EXAMPLE.com/en/", "http://example.com/english",
    "http://a.net/es/1", "http://net/fr/", "http://a.net/fr", "http://xnet/es/1", "http://b.org/en/1", "ftp://c.com", "http://c.com/",
    "http://c.com?x=/en/", "no scheme/en/", "", None, "://", "http://free-poker.example.org/en/1", "http://freepoker.example.org/en/2",
    "http://library.example.org/en/3", "http://a.com://b/en/", "http://a.net/es/1",
]


def url_parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] + [len(tail)])]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def test_url_rules(spark):
    html = "<html><script>var x</script><p>the library of the free people</p></html>"
    ordinary = [f"http://www.place{i % 9}.example.org/{'en' if i % 2 else 'fr'}/{i}" for i in range(80)]
    given = [(i, u, html, "x") for i, u in enumerate(URLS + ordinary)]
    pages = spark.createDataFrame(given, "page_id LONG, url STRING, html STRING, _host STRING")
    got = {r.page_id: r for r in urls.judge_urls(pages).collect()}
    for i, url in enumerate(URLS):
        host, path = url_parts(url)
        assert (got[i].host, got[i].path) == (host, path)
        fits = [r for r in urls.RULES for h, s, p in [r.site.partition("/")]
                if (host == h or host.endswith("." + h)) and path.startswith(s + p)]
        best = max(fits, key=lambda r: len(r.site)) if fits else None
        assert got[i].rule == (best.site if best else None)
        if best:
            assert got[i].verdict == best.verdict
    assert {i: got[i].verdict for i in (16, 17, 18)} == {16: "block", 17: "block", 18: "allow"}
    assert [got[i].verdict for i in (13, 14, 15)] == ["allow"] * 3
    assert all(got[i].verdict == "allow" for i in range(len(URLS), len(given)))
    assert urls.judge_urls(pages.limit(0)).collect() == []


def test_segmentation_is_the_likeliest_split():
    shares = {"the": 0.1, "there": 0.02, "re": 0.01, "in": 0.05, "casino": 1e-4, "win": 1e-4, "cas": 1e-6}
    s = urls.Segmenter(shares, 10_000)
    assert s.split("casinowin") == ("casino", "win") and s.split("therein") == ("there", "in") and s.split("") == ()

    def best(name):
        if not name:
            return 0.0
        return min(s._word(name[:k]) + best(name[k:]) for k in range(1, len(name) + 1))

    for name in ("thewinre", "zzthe", "inwincasin", "qx"):
        assert sum(s._word(w) for w in s.split(name)) == pytest.approx(best(name))


def brute_odds(pages):
    """Log odds by dictionaries: every word of every url, and every markup word seen twice."""
    seen = Counter(w for _, _, html in pages for w in re.findall(r"[^\W\d_]+", html.lower()) if len(w) <= urls.LONGEST_WORD)
    total = sum(seen.values())
    shares = {w: n / total for w, n in seen.items() if n >= 2}
    shares |= {w: max(shares.get(w, 0.0), urls.SEED_SHARE) for w in urls.UNWANTED}
    segmenter = urls.Segmenter({w: p for w, p in shares.items() if len(w) > 1 or w in "aiyoe"}, total)
    split = {}
    words = []
    for _, url, _ in pages:
        names = urls.url_names(*url_parts(url))
        split |= {n: segmenter.split(n) for _, n in set(names) if n not in split}
        words.append(Counter(mark + w for mark, n in names for w in split[n]))
    bad = [any(w.lstrip("/") in urls.MARKING for w in ws) for ws in words]
    block, every = Counter(dict.fromkeys(urls.MARKING, urls.SEED_COUNT)), Counter(dict.fromkeys(urls.MARKING, urls.SEED_COUNT))
    for ws, b in zip(words, bad, strict=True):
        every.update(ws)
        block.update(ws if b else {})
    n, nb, smooth = sum(every.values()), sum(block.values()), urls.SMOOTHING

    def weight(w):
        base = smooth * (every[w] + 1) / (n + len(every))
        return math.log((block[w] + base) / (nb + smooth)) - math.log((every[w] - block[w] + base) / (n - nb + smooth))

    prior = math.log((sum(bad) + 1) / (len(bad) - sum(bad) + 1))
    return {i: prior + sum(c * weight(w) for w, c in ws.items()) for (i, _, _), ws in zip(pages, words, strict=True)}


@pytest.mark.parametrize("many", [1, 1_100_000])
def test_rare_words_count_at_every_size(spark, many):
    """Markup words seen twice and url words seen once weigh the same way in small and in large tables."""
    given = [
        (0, "http://garden.org/" + "en/" * many, "<p>" + "filler " * (2 * many) + "</p>"),
        (1, "http://casino.org/quixotry", "<p>zephyr lantern</p>"),
        (2, "http://garden.org/quixotry", "<p>zephyr lantern</p>"),
        (3, "http://zephyrlantern.org/en", ""),
        (4, "http://zephyrlantern.org/en", ""),
        (5, "http://garden.org/onceonly", ""),
    ]
    got = {r.page_id: r.log_odds for r in urls.judge_urls(spark.createDataFrame(given, "page_id LONG, url STRING, html STRING")).collect()}
    want = brute_odds(given)
    assert got == {i: pytest.approx(x, rel=1e-9, abs=1e-9) for i, x in want.items()}
    assert got[3] == got[4]


def test_licences(spark, tmp_path):
    files = [
        ("lib/LICENSE", "Released under the MIT License."),
        ("lib/a/b.txt", "some words of a text that says nothing"),
        ("lib/a/own.txt", "Licensed under the Apache License, Version 2.0.\n" + "more text " * 40),
        ("lib/a/deep/LICENSE", "Licensed under CC BY-NC 4.0."),
        ("lib/a/deep/x.txt", None),
        ("other/y.txt", "nothing about a licence at all, permitted use of public works"),
        ("lib/two.txt", "All rights reserved. x\nThis work is licensed under the GNU General Public License, version 3."),
        ("top.txt", ""),
        (None, "plain"),
        ("lib/a/b.txt", "some words of a text that says nothing"),
    ]
    path = str(tmp_path / "t")
    spark.createDataFrame([(p, t, i, i) for i, (p, t) in enumerate(files)], "path STRING, text STRING, _row INT, unit INT").write.parquet(path)
    frame = licenses.scan_licences(spark.read.parquet(path))
    got = {r["_row"]: r for r in frame.collect()}
    assert len(got) == len(files)
    told = {i: (r.own_license, r.license, r.inherited_from, r.is_license_file) for i, r in got.items()}
    assert told == {
        0: ("MIT", "MIT", None, True),
        1: (None, "MIT", "lib/LICENSE", False),
        2: ("Apache-2.0", "Apache-2.0", None, False),
        3: ("CC-BY-NC-4.0", "CC-BY-NC-4.0", None, True),
        4: (None, "CC-BY-NC-4.0", "lib/a/deep/LICENSE", False),
        5: (None, None, None, False),
        6: (told[6][0], told[6][0], None, True),
        7: (None, None, None, False),
        8: (None, None, None, False),
        9: (None, "MIT", "lib/LICENSE", False),
    }
    assert sorted(got[6].licenses) == ["GPL-3.0", "Proprietary"]
    assert licenses.scan_licences(spark.read.parquet(path).limit(0)).collect() == []


LINE_CUT = r"\n|(?<=[.!?;])[\x20\t\r]+"
JOINED_CUT = r"\n(?=[\x20\t\r]*(?:\n|$))|(?<=[.!?;])[\x20\t\r\n]+"


def brute_licences(texts, threshold=0.6, file_threshold=0.5):
    """{text number: (licence, score, licensed words, like a licence file)} by dictionaries."""
    lines = [[u for u in re.split(LINE_CUT, t or "") if licenses._terms(u)] for t in texts]
    df = Counter(term for units in lines for u in units for term in set(licenses._terms(u)))
    many = sum(map(len, lines))

    def vector(text):
        return {t: (1 + math.log(n)) * (math.log((many + 1) / (df[t] + 1)) + 1) for t, n in Counter(licenses._terms(text)).items()}

    def cosine(x, y):
        return round(sum(x[t] * y.get(t, 0.0) for t in x) / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values())), 9)

    headers = [(name, vector(t)) for name, t in licenses.TEMPLATES]
    wholes = [(name, vector(t)) for name, t in licenses.WHOLE.items()]
    out = {}
    for i, text in enumerate(texts):
        joined = [u for u in re.split(JOINED_CUT, text or "") if sum(bool(licenses._terms(p)) for p in re.split(LINE_CUT, u)) > 1]
        strong = set(licenses._terms(" ".join(licenses.STRONG))) & set(licenses._terms(text or ""))
        found, words = [], [0, 0]
        for kind, units in enumerate((lines[i], joined)):
            for u in units:
                score, name = max((cosine(vector(u), v), n) for n, v in headers)
                if score >= threshold:
                    found.append((True, -score, name))
                    words[kind] += len(u.encode().split())
        if len(strong) >= licenses.STRONG_WORDS:
            score, name = max((cosine(vector(text), v), n) for n, v in wholes)
            if score >= file_threshold:
                found.append((False, -score, name))
        if found:
            later, score, name = min(found)
            out[i] = (name, pytest.approx(-score, abs=1e-8), max(words), any(not f[0] for f in found))
    return out


def one_line(text):
    return " ".join(text.split())


def wrapped(text, width):
    return "\n\n".join(textwrap.fill(one_line(p), width) for p in re.split(r"\n\s*\n", text))


def licence_corpus():
    """(path, text, licence that it is a file of): whole licences in several shapes, and texts that only speak of licences."""
    files = []
    for name, text in licenses.WHOLE.items():
        owned = f"Copyright (c) 2019 Some Body <some@body.org>\nAll of it.\n\n{text}"
        for shape, made in {"as": owned, "wide": wrapped(owned, 110), "narrow": wrapped(owned, 38), "line": one_line(owned),
                            "crlf": owned.replace("\n", "\r\n"), "curly": owned.replace('"', "\u201c")}.items():
            files.append((f"{name}-{shape}/LICENSE", made, name))
            files.append((f"{name}-{shape}/src/deep/x.py", "import os\nprint(os.name)\n", None))
    code = "\n".join(f"def f{i}(x):\n    return x + {i}  # step {i} of many" for i in range(120))
    header = "# Licensed under the Apache License, Version 2.0 (the License);\n# you may not use this file except in compliance with the License.\n"
    files.append(("code/a.py", header + code, None))
    files.append(("code/b.py", "# This program is free software: you can redistribute it and modify it under\n# the terms of the GNU General Public License as\n# published by the Free Software Foundation, version 3.\n" + code, None))
    talk = "We spoke of the license and its conditions, of copyright, liability and warranties, and a patent granted long ago. "
    files.append(("talk/a.txt", talk + "The weather was fine, and the river ran past the mill. " * 30, None))
    files.append(("talk/b.txt", None, None))
    return files


def test_whole_licences_are_licence_files(spark, tmp_path):
    files = licence_corpus()
    path = str(tmp_path / "t")
    spark.createDataFrame([(p, t, i) for i, (p, t, _) in enumerate(files)], "path STRING, text STRING, no INT").repartition(3).write.parquet(path)
    got = {r["no"]: r for r in licenses.scan_licences(spark.read.parquet(path)).collect()}
    for i, (p, _, name) in enumerate(files):
        if name:
            assert (got[i].own_license, got[i].is_license_file) == (name, True), (p, got[i])
            assert (got[i + 1].license, got[i + 1].inherited_from) == (name, p)
        else:
            assert not got[i].is_license_file, p
    told = {p: got[i].own_license for i, (p, _, _) in enumerate(files)}
    assert (told["code/a.py"], told["code/b.py"], told["talk/a.txt"]) == ("Apache-2.0", "GPL-3.0", None)


def test_licence_scores_equal_brute_force(spark, tmp_path):
    files = licence_corpus()[::3] + licence_corpus()[-4:]
    path = str(tmp_path / "t")
    spark.createDataFrame([(str(i), t, i) for i, (_, t, _) in enumerate(files)], "path STRING, text STRING, no INT").write.parquet(path)
    stored = number_rows(spark.read.parquet(path))
    number = {r["_row"]: r["no"] for r in stored.collect()}
    got = {number[r["_row"]]: r for r in licenses.own_licences(stored.select("_row", "text")).collect()}
    want = brute_licences([t for _, t, _ in files])
    assert {i: (r.own_license, r.own_score, r.licensed_words, r.like_file) for i, r in got.items()} == want


@pytest.mark.parametrize("name", ["Apache-2.0", "GPL-3", "GPL-2", "LGPL-3", "MPL-2.0", "CC0-1.0"])
def test_real_licence_files(spark, tmp_path, name):
    """The texts that come with the operating system, where it has them."""
    file = f"/usr/share/common-licenses/{name}"
    if not os.path.exists(file):
        pytest.skip("no such file here")
    with open(file) as f:
        text = f.read()
    rows = [("a/LICENSE", text), ("b/LICENSE", one_line(text)), ("a/x/y.c", "int x;"), ("b/y.c", "int y;")]
    spark.createDataFrame(rows, "path STRING, text STRING").write.parquet(str(tmp_path / "t"))
    got = {r.path: r for r in licenses.scan_licences(spark.read.parquet(str(tmp_path / "t"))).collect()}
    want = name if name[-2:] == ".0" else f"{name}.0"
    assert all(r.license == want for r in got.values()) and got["a/LICENSE"].is_license_file and got["b/LICENSE"].is_license_file


def test_licence_scores_count_every_unit(spark, tmp_path):
    """Frequencies are of all lines and sentences, also of those without a template word."""
    texts = ["Released under the MIT License for zebras.", "zebras\nzebras graze. zebras sleep\n\n...\nzebras", "ordinary words\nzebras " * 9, None]
    spark.createDataFrame([(f"{i}", t, i) for i, t in enumerate(texts)], "path STRING, text STRING, no INT").write.parquet(str(tmp_path / "t"))
    got = {r["no"]: r for r in licenses.scan_licences(spark.read.parquet(str(tmp_path / "t")), threshold=0.1).collect()}
    units = [set(licenses._terms(u)) for t in texts for u in re.split(LINE_CUT, t or "")]
    units = [u for u in units if u]
    df = Counter(t for u in units for t in u)

    def vector(text):
        return {t: (1 + math.log(n)) * (math.log((len(units) + 1) / (df[t] + 1)) + 1) for t, n in Counter(licenses._terms(text)).items()}

    def cosine(x, y):
        return sum(x[t] * y.get(t, 0.0) for t in x) / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))

    best = max((cosine(vector(texts[0]), vector(t)), name) for name, t in licenses.TEMPLATES)
    assert (got[0].own_license, got[0].own_score) == (best[1], pytest.approx(best[0], abs=1e-8))


AWKWARD = ["", None, "a", "  x  ", " hello　wor ld don't it's  ÄÖ ǅ Σας İ ﬁ \x1c b\x85c é ́x <|endoftext|> <|startoftext|>y",
           "H̱i H̱ ok.!?, ... a.b,c ,x U.S.A. x's 'quoted' 123abc ABC,,, Ünï̈", "\x00\x01 a"]


def test_encoder_gives_the_tokenizers_ids(rows):
    import pyarrow as pa
    from tokenizers import Tokenizer

    texts = [t for _, t, _, _ in rows] + AWKWARD
    whole = Tokenizer.from_file(TOKENIZER)
    encoder = packing.Encoder(TOKENIZER)
    for _ in range(2):  # the second time every word is known
        ids, at = encoder.encode(*T.texts(pa.array(texts, pa.string())), 0)
        for i, t in enumerate(texts):
            assert ids[at[i] : at[i + 1]].tolist() == whole.encode(t or "", add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing(docs, rows, nothing, capacity):
    import numpy as np
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(TOKENIZER)
    packed = packing.pack_documents(docs, TOKENIZER, capacity).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in packed:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc_id, text, _, _ in rows:
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        pieces = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // capacity)))
        for r in pieces:
            part = ids[r.piece * capacity : (r.piece + 1) * capacity]
            assert (r.start, r.length, r.ids_crc32) == (r.piece * capacity, len(part), zlib.crc32(part.tobytes()))
    for members in by_sequence.values():
        place = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == place
            place += r.length
        assert place <= capacity
    least = -(-sum(r.length for r in packed) // capacity)
    assert len(by_sequence) <= least * 1.05 + 1
    assert packing.pack_documents(nothing, TOKENIZER).collect() == []


def test_evolution_never_loses_a_piece_and_beats_best_fit():
    rng = random.Random(2)
    lengths = [rng.randint(20, 60) for _ in range(300)]
    plain = packing._best_fit([], sorted(range(300), key=lambda i: -lengths[i]), lengths, 100)
    label = packing.evolve(lengths, 100, [], random.Random(1), population=6, generations=30)
    bins = defaultdict(int)
    for i, b in enumerate(label):
        bins[b] += lengths[i]
    assert max(bins.values()) <= 100 and len(label) == 300 and len(bins) <= len(plain)
    again = packing.evolve(lengths, 100, [label], random.Random(9))
    assert max(again) + 1 <= len(bins)
    child = packing.crossover(plain, packing._best_fit([], list(range(300)), lengths, 100), lengths, 100, random.Random(3), full=0.9)
    assert sorted(i for b in child for i in b) == list(range(300))


def thue_morse_words(n=1024):
    """A word over two letters and its complement, which every polynomial modulo a power of two hashes alike."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_that_differ_have_hashes_that_differ():
    rng = random.Random(2)
    made = {*thue_morse_words(256), *thue_morse_words(1024), *thue_morse_words(4096)}
    made |= {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 40))) for _ in range(5000)}
    made |= {"a" * n for n in range(1, 1200)} | {"a" * n + "b" for n in range(1, 1200)}
    words = sorted(made)
    raw = " ".join([*words, *reversed(words)]).encode()
    data = np.frombuffer(raw, np.uint8)
    starts, ends, _ = T.words(data, np.array([0, len(data)]))
    hashes = T.word_hashes(data, starts, ends)
    assert len(set(hashes.tolist())) == len(words)
    assert (hashes[: len(words)] == hashes[len(words) :][::-1]).all()  # wherever a word stands


def test_operators_tell_such_words_apart(spark, tmp_path):
    one, other = thue_morse_words()
    tail = " ".join(f"t{i}" for i in range(3))
    texts = [f"{one} {tail} {one}", f"{other} {tail} {other}", f"{one} {tail} {one}"]
    path = str(tmp_path / "t")
    spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id LONG, text STRING, source STRING").write.parquet(path)
    docs = spark.read.parquet(path)
    assert {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()} == {0: 0, 1: 1, 2: 0}
    gone = {r[REST]["doc_id"]: r["_n_removed"] for r in substrings.dedup_substrings(docs, 5).collect()}
    assert gone == {0: 5, 1: 0, 2: 5}
    file = tokenizer_path("word_bpe_49k.json")
    got = {r.doc_id: r.ids_crc32 for r in packing.pack_documents(docs, file).collect()}
    for i, t in enumerate(texts):
        ids = [*packing._encoder(file).tokenizer.encode(t, add_special_tokens=False).ids, 0]
        assert len(ids) > 2048 or got[i] == zlib.crc32(np.array(ids, "<u4").tobytes())
    scored = {r.doc_id: r.score for r in lm.cross_entropy_difference(docs, docs.where("doc_id <> 1").select("text")).collect()}
    assert scored[0] == scored[2] < scored[1]


def test_an_encoder_whose_hashes_collide_still_encodes_words(monkeypatch):
    monkeypatch.setattr(T, "word_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    encoder = packing.Encoder(tokenizer_path("word_bpe_49k.json"))
    texts = ["alpha beta alpha", "", "gamma beta. Alpha"]
    raw = "".join(texts).encode()
    at = np.cumsum([0, *[len(t) for t in texts]])
    for _ in range(2):
        ids, offsets = encoder.encode(np.frombuffer(raw, np.uint8), at, 0)
        got = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        assert got == [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in texts]


@pytest.mark.parametrize("seed", range(3))
def test_search_beats_best_fit_where_that_is_poor(seed):
    """Triplets that fill a bin exactly: best-fit decreasing wastes a fifth, crossover of full bins wins some of it back."""
    rng, lengths = random.Random(seed), []
    for _ in range(20):
        a = rng.randint(380, 490)
        b = rng.randint(250, (1000 - a) // 2)
        lengths += [a, b, 1000 - a - b]
    rng.shuffle(lengths)
    down = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    plain = len(packing._best_fit([], down, lengths, 1000))

    def bins(population, generations):
        label = packing.evolve(lengths, 1000, [], random.Random(1), population, generations)
        held = Counter()
        for i, b in enumerate(label):
            held[b] += lengths[i]
        assert max(held.values()) <= 1000 and sorted(held) == list(range(len(held)))
        return len(held)

    assert bins(packing.POPULATION, packing.GENERATIONS) <= plain
    assert bins(20, 100) < plain
