"""The operators against brute force on small tables, and on odd rows."""

from __future__ import annotations

import base64
import binascii
import hashlib
import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from isohour.llm import bpe, common, packing, pages, passages, quality, quotes, rules, setsketch, shingles, urls, vectors

FOLDER = "/root/testdata/sf0.001"
BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def collected(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def top_of(links, ids):
    root = {i: i for i in ids}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def pairs_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_bpe_equals_tiktoken(request, which):
    docs = request.getfixturevalue(which)
    with open(BYTE_BPE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for key, text in pairs_of(docs):
        ids = own.encode_ordinary(text)
        digests = (hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), text.encode()))
        want.append((key, len(ids), *digests))
    found = collected(bpe.round_trip(docs, BYTE_BPE, public_tokenizers.PATTERN), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert Counter(found) == Counter(want)
    assert bpe.decode(bpe.encode(docs.limit(3), BYTE_BPE, public_tokenizers.PATTERN), BYTE_BPE, public_tokenizers.PATTERN).count() == 3


def long_pieces():
    rng = np.random.default_rng(5)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    return [
        "".join(rng.choice(letters, 20_000)),
        "a" * 5001,
        "ab" * 2500 + "a",
        "".join(rng.choice(["aa", "aaa", "ab", "ba", "b"], 3000)),
        "é" * 700 + "".join(map(chr, rng.integers(0x4E00, 0x9FA5, 3000))),
        "=" * 1000,
        *("".join(rng.choice(letters, 257 + k)) for k in range(40)),
    ]


@pytest.mark.parametrize("regular", [True, False])
def test_long_pieces_equal_tiktoken(monkeypatch, regular):
    with open(BYTE_BPE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = long_pieces() if regular else [text[:300] for text in long_pieces()[:6]]
    if not regular:
        monkeypatch.setattr(bpe.Bpe, "last_merge", lambda self, token, rank: None)
    coder = bpe.Bpe(BYTE_BPE, public_tokenizers.PATTERN)
    found = coder.encode(texts)
    assert [ids.tolist() for ids in found] == [own.encode_ordinary(text) for text in texts]
    assert coder.decode(found) == [text.encode() for text in texts]
    assert (coder.long_step == bpe.MANY.format(picked=bpe.PICK_MANY)) == regular


def test_quality_rules_shuffle_no_kept_texts(spark, odd):
    """The stage keeps the ids that the rules keep, all their rows and a missing id too, and no text of a kept row meets a join."""
    prose = " ".join(f"word{i}" for i in range(90))
    more = spark.createDataFrame([(4, "bad", "en"), (None, prose, "en"), (None, "bad", "en"), (77, "bad", "en")], "doc_id long, text string, lang string")
    docs = odd.select("doc_id", "text", "lang").unionByName(more)
    kept = {r.doc_id for r in rules.judge(docs).where("kept").collect()}
    want = Counter(tuple(r) for r in docs.collect() if r.doc_id in kept)
    found = corpus_pipeline.quality_rules(spark, docs, "")
    assert Counter(map(tuple, found.collect())) == want and {4, None} <= kept and 77 not in kept
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and plan.index("Join") > plan.index("Project")


def test_full_memory_keeps_the_words_in_use(monkeypatch):
    """Words of the present texts are not encoded anew when a worker's memory is full, and pieces met in other words never."""
    coder, contracted = bpe.Bpe(BYTE_BPE, public_tokenizers.PATTERN), []
    contract = coder.contract
    monkeypatch.setattr(coder, "contract", lambda pieces: contracted.extend(pieces) or contract(pieces))
    first, more = [" ".join(f"qzx{c}vwk" for c in letters) for letters in ("abcdefgh", "abcdefghij")]
    want = [ids.tolist() for ids in coder.encode([first, more + "!?", "", None])]
    assert len(contracted) == len(set(contracted))
    coder = bpe.Bpe(BYTE_BPE, public_tokenizers.PATTERN)
    contract = coder.contract
    monkeypatch.setattr(coder, "contract", lambda pieces: contracted.extend(pieces) or contract(pieces))
    monkeypatch.setattr(bpe, "REMEMBERED", 12)
    found = coder.encode([first])
    contracted.clear()
    assert [ids.tolist() for ids in found + coder.encode([more + "!?", "", None])] == want
    assert {piece.strip() for piece in contracted} <= {b"qzxivwk", b"qzxjvwk", b"!?"}


def test_bpe_of_no_rows_and_a_table_with_more_columns(spark, docs, odd):
    assert bpe.round_trip(docs.where("false"), BYTE_BPE, public_tokenizers.PATTERN).count() == 0
    assert bpe.round_trip(odd, BYTE_BPE, public_tokenizers.PATTERN).count() == odd.count()


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_rule_counts(request, which):
    docs = request.getfixturevalue(which)
    want = []
    for key, text in pairs_of(docs):
        words, seen, copies = WORD.findall(text), set(), 0
        places = defaultdict(list)
        for i in range(len(words) - 4):
            places[tuple(words[i : i + 5])].append(i)
        covered = {x for v in places.values() if len(v) > 1 for i in v for x in range(i, i + 5)}
        for line in text.split("\n"):
            if WORD.search(line):
                copies += line in seen
                seen.add(line)
        n = len(words)
        failed = n < 10 or 100 * len(covered) > 20 * n
        want.append((key, n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), copies, len(covered), failed))
    found = rules.judge(docs)
    assert Counter(collected(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == Counter(want)
    assert found.where("base_failed AND kept").count() == 0


def test_rules_keep_good_documents(spark):
    folder = FOLDER.replace("0.001", "0.01")
    found = rules.judge(spark.read.parquet(f"{folder}/documents.parquet")).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    share = {r.quality: r.s for r in found.where("NOT base_failed").groupBy("quality").agg({"kept": "count"}).withColumnRenamed("count(kept)", "s").collect()}
    kept = {r.quality: r["count"] for r in found.where("kept").groupBy("quality").count().collect()}
    assert kept[1] > 0.95 * share[1] and kept.get(0, 0) < 0.3 * share[0]


def planted_votes(seed, n, good, right, silent):
    """Patterns of rules with known accuracies on good and bad documents, and how often each occurs."""
    rng = np.random.default_rng(seed)
    is_good = rng.random(n) < good
    columns = []
    for on_good, on_bad in right:
        correct = rng.random(n) < np.where(is_good, on_good, on_bad)
        columns.append(np.where(rng.random(n) < silent, 0, np.where(correct == is_good, 1, -1)))
    return is_good, Counter(map(tuple, np.array(columns).T.tolist()))


@pytest.mark.parametrize("seed", range(3))
def test_planted_accuracies_are_recovered(seed):
    right = [(0.95, 0.8), (0.9, 0.7), (0.98, 0.5), (0.85, 0.85), (0.97, 0.1), (0.9, 0.6)]
    _, patterns = planted_votes(seed, 40_000, 0.8, right, 0.2)
    names = [f"r{k}" for k in range(len(right))]
    weights, trace = rules.estimate(sorted(patterns.items()), names, rounds=1000, belief=0.0001)
    assert all(b >= a - 1e-9 * abs(a) for a, b in zip(trace, trace[1:])) and len(trace) > 3
    assert weights.good == pytest.approx(0.8, abs=0.03)
    for name, (on_good, on_bad) in zip(names, right):
        assert weights.right[name] == (pytest.approx(on_good, abs=0.03), pytest.approx(on_bad, abs=0.06))


def test_posterior_is_bayes_and_one_bad_vote_can_be_outvoted(spark):
    folder = FOLDER.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = list(rules.votes())
    table = rules.counts(docs).withColumns(rules.votes()).join(rules.judge(docs).select("doc_id", "kept", "base_failed", "posterior"), "doc_id")
    rows = table.where("NOT base_failed").collect()
    patterns = Counter(tuple(r[n] for n in names) for r in rows)
    weights, trace = rules.estimate(sorted(patterns.items()), names)
    assert all(b >= a - 1e-9 * abs(a) for a, b in zip(trace, trace[1:]))
    for r in rows:
        good, bad = weights.both({n: r[n] for n in names})
        assert r.posterior == pytest.approx(1 / (1 + np.exp(bad - good))) and r.kept == (r.posterior >= 0.5)
    one_bad = [r.kept for r in rows if sum(r[n] == -1 for n in names) == 1]
    assert any(one_bad) and not all(r.kept for r in rows)
    assert rules.judge(docs.where("false")).count() == 0


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_packing_covers_every_id_once(request, which):
    docs = request.getfixturevalue(which)
    own = Tokenizer.from_file(WORD_BPE)
    rows = packing.pack(docs, WORD_BPE, size=256).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    times = Counter(key for key, _ in pairs_of(docs))
    for key, text in dict(pairs_of(docs)).items():
        ids = np.array([*own.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert sum(r.length for r in pieces[key]) == len(ids) * times[key]
        for r in pieces[key]:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == binascii.crc32(ids[r.start : r.start + r.length].tobytes())


def test_packing_takes_the_tokenizer_as_loaded(spark):
    texts = ["end of page <|endoftext|> next", "a<|startoftext|>b <|ENDOFTEXT|> é\u00a0x <|endoftext|>", "<|endoftext|>", "<|endoftext |>"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own = Tokenizer.from_file(WORD_BPE)
    found = packing.pack(table.coalesce(1), WORD_BPE).collect()
    for key, text in enumerate(texts):
        ids = np.array([*own.encode(text, add_special_tokens=False).ids, 2], "<u4")
        pieces = [r for r in found if r.doc_id == key]
        assert sum(r.length for r in pieces) == len(ids)
        assert all(r.ids_crc32 == binascii.crc32(ids[r.start : r.start + r.length].tobytes()) for r in pieces)
    assert packing.pack(table.where("false"), WORD_BPE).count() == 0


def test_cuts_are_optimal():
    rng = np.random.default_rng(1)
    for _ in range(30):
        at = np.unique(rng.integers(1, 60, 12))
        at = np.union1d(at, np.arange(5, at[-1], 5))
        penalty = rng.integers(0, 9, len(at)).astype(float)

        def cost(ends):
            return sum(penalty[np.searchsorted(at, e)] + 10 - (e - b) for b, e in zip([0, *ends], ends))

        inner = at[:-1].tolist()
        best = min(
            cost([*c, at[-1]])
            for n in range(len(inner) + 1)
            for c in itertools.combinations(inner, n)
            if all(e - b <= 10 for b, e in zip([0, *c], [*c, at[-1]]))
        ) if len(inner) <= 14 else None
        if best is not None:
            assert cost(packing.cuts(at, penalty, 10)) == best


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_near_duplicates_equal_brute_force(request, which):
    docs = request.getfixturevalue(which)
    sets = {}
    for key, text in pairs_of(docs):
        words = text.encode().lower().split()
        sets[key] = set(zip(words, words[1:])) if len(words) > 1 else {tuple(words)} if words else set()
    links = [(a, b) for a, b in itertools.combinations([k for k in sets if k is not None and sets[k]], 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    tops = top_of(links, [k for k in sets if k is not None])
    found = setsketch.near_duplicates(docs).where("doc_id IS NOT NULL").collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found} == {(k, len(sets[k]), t, t == k) for k, t in tops.items()}


def test_pipeline_drops_near_copies_by_five_words_only(spark, docs):
    words = [f"w{i}" for i in range(200)]
    loose = [f"changed{i}" if i % 24 == 12 else w for i, w in enumerate(words)]  # 0.85 by two words, 0.66 by five
    near = [f"changed{i}" if i == 99 else w for i, w in enumerate(words)]
    made = [(10_000 + k, " ".join(w), "en", "s", 1) for k, w in enumerate((words, loose, near))]
    rows = docs.unionByName(spark.createDataFrame(made, docs.schema))
    sets = {}
    for key, text in pairs_of(rows):
        found = text.encode().lower().split()
        sets[key] = {tuple(found[i : i + 5]) for i in range(max(len(found) - 4, 1))} if found else set()
    links = [(a, b) for a, b in itertools.combinations([k for k in sets if sets[k]], 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    kept = {k for k, t in top_of(links, list(sets)).items() if t == k}
    assert {10_000, 10_001} <= kept and 10_002 not in kept
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, rows, FOLDER).select("doc_id").collect()} == kept


def test_a_chain_of_near_copies_is_one_component(spark, docs):
    words = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(40):
        words = words.copy()
        words[(k * 7) % 200] = f"changed{k}"
        rows.append((k, " ".join(words)))
    found = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.component_id for r in found.collect()} == {0}


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_repeated_passages_equal_brute_force(request, which):
    docs = request.getfixturevalue(which).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = {k: t.encode() for k, t in pairs_of(docs)}
    seen = Counter(raw[i : i + 60] for raw in texts.values() for i in range(len(raw) - 59))
    want = set()
    for key, raw in texts.items():
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - 59):
            if seen[raw[i : i + 60]] > 1:
                gone[i : i + 60] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        left = bytes(b for b, g in zip(raw, gone) if not g)
        want.add((key, len(raw), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    found = passages.deduplicate(docs, length=60, short=24)
    assert set(collected(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == want


def test_vectors_equal_brute_force(spark, docs):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(6, 8))
    values = [(base[i % 6] + rng.normal(scale=0.12 * (i % 3), size=8)).astype(np.float32).tolist() for i in range(300)]
    rows = [(i, v, i % 6 % 2, "x") for i, v in enumerate(values)]
    nan = [float("nan")] + [1.0] * 7
    rows += [(300, None, 0, ""), (301, [0.0] * 8, 0, ""), (302, nan, 0, ""), (303, [None] + [1.0] * 7, 1, ""), (304, values[0], None, ""), (305, values[0], 0, ""), (306, [], 1, "")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n string")
    sound = {i: (np.array(v, np.float64), label) for i, v, label, _ in rows if i < 300 or i == 305}
    links = []
    for a, b in itertools.combinations(sound, 2):
        (x, lx), (y, ly) = sound[a], sound[b]
        if lx == ly and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98:
            links.append((a, b))
    count, tops = Counter(v for link in links for v in link), top_of(links, [r[0] for r in rows])
    found = vectors.near_duplicates(table, tile=16)
    assert set(collected(found, "vec_id", "n_links", "component_id", "kept")) == {(i, count[i], t, t == i) for i, t in tops.items()}
    assert vectors.near_duplicates(table.where("false")).count() == 0


def test_pages(spark, docs):
    shared = "<p>Site menu</p><p>All rights reserved</p>"
    own = "A longer sentence of this page alone, number"
    rows = [
        (1, "http://a.org/x/1", f"<body>{shared}<p>{own}  &lt;one&gt;</p></body>"),
        (2, "http://a.org/x/2", f"<body>{shared}<p>{own} an<b>other</b></p></body>"),
        (3, "http://b.org/", "<nav>menu</nav><article><header><h1>T</h1></header><p>a<br>b</p><div class='ad'>buy</div></article><footer>f</footer>"),
        (4, None, None),
        (5, "x", "<article>cut off <p>te"),
    ]
    found = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1))
    texts = {r.page_id: r.text for r in found.collect()}
    assert texts == {1: f"{own} <one>", 2: f"{own} another", 3: "T a b", 4: "", 5: "cut off te"}
    assert pages.common(list("abcde"), list("xbyde")) == [(1, 1), (3, 3), (4, 4)]


def test_every_page_is_compared_with_the_nearest(spark):
    """Pages with an article are compared too and keep what they share; others lose what the nearest page shows
    anywhere, its marked menu included, be it the one before or behind; a copy is passed over for the other neighbour."""
    text = "A longer sentence that only stands here, which is page"
    rows = [
        (1, "http://a.org/x/1", f"<p>Home</p><p>{text} one</p>"),
        (2, "http://a.org/x/2", f"<nav><p>Home</p></nav><article><p>{text} two</p><p>shared</p></article>"),
        (3, "http://a.org/x/3", f"<nav><p>Home</p></nav><article><p>shared</p><p>{text} three</p></article>"),
        (4, "http://b.org/a", f"<main><p>Start</p><p>{text} four</p></main>"),
        (5, "http://b.org/news/1", f"<main><p>News</p><p>{text} five</p></main>"),
        (6, "http://b.org/news/2", f"<main><p>News</p><p>{text} six</p></main>"),
        (7, "http://c.org/1", f"<p>Top</p><p>{text} seven</p>"),
        (8, "http://c.org/2", f"<p>Top</p><p>{text} eight</p>"),
        (9, "http://c.org/2", f"<p>Top</p><p>{text} eight</p>"),
        (10, "http://d.org/", "<p>out <span class='ad'>buy</span> side</p>"),
    ]
    found = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1))
    texts = {r.page_id: r.text for r in found.collect()}
    assert texts == {
        1: f"{text} one", 2: f"{text} two shared", 3: f"shared {text} three", 4: f"Start {text} four", 5: f"{text} five", 6: f"{text} six",
        7: f"{text} seven", 8: f"{text} eight", 9: f"Top {text} eight", 10: "out side",
    }


def test_url_rules(spark, docs):
    ruled = urls.parse_rules("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")
    given = {
        "http://EXAMPLE.org/es/3": "example.org/es/", "https://www.example.org/en/12?x=1": "example.org/en/1", "https://www.example.org/en/2": "org/",
        "http://badexample.com/fr/1#top": "com/fr/", "http://x.net/": None, "no url": None, "http://a.org": None, "http://a.com/de/": "com/de/", None: None,
    }
    table = spark.createDataFrame([(i, u) for i, u in enumerate(given)], "page_id long, url string")
    found = urls.judge(table, ruled, trees=2)
    assert {r.page_id: r.rule for r in found.collect()} == dict(enumerate(given.values()))
    by_id = {r.page_id: r for r in found.collect()}
    assert (by_id[0].host, by_id[0].path) == ("example.org", "/es/3") and (by_id[5].host, by_id[5].path) == ("", "")
    assert urls.judge(table.where("false"), ruled).count() == 0


def test_rates_leave_the_own_fold_out(spark):
    rows = [("a", 0, 1.0), ("a", 0, 1.0), ("a", 1, 0.0), ("a", 2, None), ("b", 3, 1.0), ("c", 1, None)]
    found = urls.with_rates(spark.createDataFrame(rows, "s string, fold int, label double"), "s").collect()
    want = [("a", 0, 1 / 3)] * 2 + [("a", 1, 3 / 4), ("a", 2, 3 / 5), ("b", 3, 1 / 2), ("c", 1, 1 / 2)]
    assert Counter((r.s, r.fold, round(r.s_rate, 9)) for r in found) == Counter((s, f, round(x, 9)) for s, f, x in want)


def test_url_trees_on_rows_without_a_rule(spark):
    """Rules hidden from the operator: hosts whose rule is known teach it, and repeated and long rows are judged each."""
    ruled = urls.parse_rules("allow org/", "block net/")
    given = [f"http://h{i}.{'org' if i % 2 else 'net'}/{'x' * 3 if i % 2 else 'ad/banner?id=12345&c=6789'}{i}" for i in range(400)]
    unknown = ["http://q.io/xxx5", "http://q.io/ad/banner?id=12345&c=678917", "http://q.io/xxx5", "http://q.io/" + "y" * 100_000]
    table = spark.createDataFrame([(i, u, "x", 1.0) for i, u in enumerate(given + unknown)], "page_id long, url string, host string, label double")
    found = {r.page_id: r for r in urls.judge(table, ruled).collect()}
    assert len(found) == 404 and found[400].verdict == found[402].verdict == "allow" and found[401].verdict == "block"
    assert found[400].rule is None and found[403].path == "/" + "y" * 100_000


def test_quality_on_held_out_rows(spark, docs):
    folder = FOLDER.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = quality.classify(spark.read.parquet(f"{folder}/documents.parquet"), labels).where("held_out").join(labels, "doc_id").toPandas()
    good, bad = scored[scored.quality == 1], scored[scored.quality == 0]
    assert good.predicted.mean() > 0.97 and bad.predicted.mean() < 0.1
    assert quality.classify(docs, labels.where("false")).select("score").distinct().collect()[0].score == 0.5


def test_isotonic_pools_violators():
    assert quality.isotonic(np.array([0.0, 1.0, 0.0, 1.0]), np.ones(4)).tolist() == [0.0, 0.5, 0.5, 1.0]


def test_quotes(spark, docs):
    rows = [
        (1, 0, "user", "Hello there.\nHow are you?\n\nSecond part"), (1, 1, "assistant", "> hello  there.\n> How are you?\nFine."),
        (1, 2, "user", ">> How are you?\n> Fine.\nGood"), (1, 3, "user", "No quote"), (1, 4, "user", "> Second part\nyes"), (2, 0, "user", None), (None, None, None, "> x"),
    ]
    linked = quotes.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = {(r.conv_id, r.turn): (r.reply_to, r.path, r.text) for r in linked.collect()}
    assert found[1, 2] == (1, [0, 1, 2], "Good") and found[1, 4] == (0, [0, 4], "yes") and found[1, 3] == (None, [3], "No quote")
    assert found[2, 0] == (None, [0], "") and found[None, None][2] == ""
    said = {r.conv_id: [m.text for m in r.messages] for r in quotes.conversations(linked).collect()}
    assert said[1] == ["Hello there.\nHow are you?\n\nSecond part", "Fine.", "Good", "yes", "No quote"]


def test_pipeline_stages_keep_columns_and_clean_documents(spark, docs, odd):
    for name, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs, FOLDER).columns == docs.columns, name
        assert stage(spark, docs.where("false"), FOLDER).count() == 0, name
        stage(spark, odd, FOLDER).count()


def test_every_operator_is_registered():
    names = [name for name in driver.queries() if re.match(r"op\d+_", name)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 11)) and "pipeline" in driver.queries()


def test_workers_keep_one_operators_words_of_bounded_bytes(monkeypatch):
    """A worker outlives its stage: the words of another operator go, and long words count by their bytes."""
    path = corpus_pipeline.public_tokenizers.path(corpus_pipeline.WORD_BPE)
    texts = [" ".join(f"{c * 3000}{k}" for k in range(4)) for c in "abcdef"]
    want = [packing.Words(path).ids(t) for t in texts]
    sets = [shingles.shingles(t).tolist() for t in texts]
    common.forget()
    monkeypatch.setattr(packing, "REMEMBERED_BYTES", 20_000)
    monkeypatch.setattr(shingles, "REMEMBERED_BYTES", 7_000)
    words = packing.words_of(path)
    assert [words.ids(t) for t in texts] == want and words is packing.words_of(path)
    assert sum(map(len, words)) + sum(map(len, words.pieces)) <= 20_000
    assert [shingles.shingles(t).tolist() for t in texts] == sets
    assert list(common._kept) == ["word hashes"]
    assert sum(map(len, common.kept("word hashes", shingles.WordHashes))) <= 7_000
