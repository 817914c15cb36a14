"""Decontamination, token alignment and fill-in-the-middle against brute force."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter, defaultdict

import duckdb
import oracle
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from isohour.llm import aligning, leaks, middles, twins

FOLDER = "/root/testdata/sf0.001"
BYTE_BPE, PIECES = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
LEAK_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leak_words(text):
    return LEAK_WORD.findall((text or "").translate(LOWER))


def leaked(docs, items, width=10):
    """Every window at every place, without an automaton."""
    windows = defaultdict(set)
    for item, text in items:
        words = leak_words(text)
        size = min(width, len(words))
        for k in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[k : k + size])].add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    for key, text in docs:
        words, hit, met = leak_words(text), set(), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                found = windows.get(tuple(words[k : k + size]))
                if found:
                    hit.update(range(k, k + size))
                    met |= found
        yield key, len(words), len(hit), len(met), sha(",".join(sorted(met))), bool(hit)


ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, "Seven, EIGHT nine"),
    (3, "three four five six seven eight nine ten eleven twelve"),
    (4, None),
    (5, " ?! "),
    (6, "É über 1a"),
    (6, "long long long long long long long long long long long"),
    (None, "word1 word2 word3 word4 word5 word6 word7 word8 word9 word10"),
    (10, "seven eight nine"),
]
TEXTS = [
    "zero one two three four five six seven eight nine ten eleven twelve end",
    "ONE two three four,five six\nseven-eight 'nine' ten",
    "seven eight nine seven eight nine",
    "é über 1a É über 1a; über 1a",
    "seven eight",
    "x seven eightnine",
]


@pytest.mark.parametrize("block", [leaks.BLOCK, 7])
def test_leaks(spark, odd, block):
    """One automaton, and several whose hits are put together."""
    benchmark = spark.createDataFrame([(*i, "clash", i[0]) for i in ITEMS], "item_id long, text string, doc_id string, n_words long")
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    docs = odd.unionByName(extra, allowMissingColumns=True)
    found = leaks.digests(leaks.find(docs, benchmark, block=block)).collect()
    want = leaked([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], ITEMS)
    assert Counter(map(tuple, found)) == Counter(want)
    assert sum(r.contaminated for r in found) >= 9


def test_leak_offsets_in_the_original(spark):
    docs = spark.createDataFrame([(1, "Ünd (Seven;  EIGHT) nine, É…über  1A! seven")], "doc_id long, text string")
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    row = leaks.find(docs, benchmark).first()
    text = docs.first().text
    assert [text[s.start : s.end] for s in row.spans] == ["Seven;  EIGHT) nine"]
    assert row["items"] == ["10", "2"] and row.n_hit == 3


def test_leaks_of_the_given_tables(spark, docs):
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    found = leaks.digests(leaks.find(docs, benchmark))
    want = leaked(*([tuple(r) for r in t.collect()] for t in (docs.select("doc_id", "text"), benchmark.select("item_id", "text"))))
    assert Counter(map(tuple, found.collect())) == Counter(want)
    assert found.where("contaminated").count() > 0


def test_leaks_of_empty_tables(spark, docs):
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    assert leaks.find(docs.limit(0), benchmark).count() == 0
    clean = leaks.digests(leaks.find(docs, benchmark.limit(0)))
    assert clean.where("contaminated OR n_hit > 0 OR n_items > 0").count() == 0 and clean.count() == docs.count()


def test_odd_rows_and_the_sql_twins(spark, odd):
    con = duckdb.connect()
    con.register("documents", odd.toArrow())
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    con.register("benchmark", benchmark.toArrow())
    assert oracle.compare(leaks.digests(leaks.find(odd, benchmark)), con, twins.LEAKS) == odd.count()
    assert oracle.compare(middles.digests(middles.transform(odd)), con, twins.MIDDLES) == odd.count()


# --- alignment ---


def token_bytes():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=PIECES)

    def both(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids[0]]
        raw_b = [
            bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids[1] for p in [b.id_to_piece(i)]
        ]
        return *ids, raw_a, raw_b

    return both


def aligned(texts):
    """Every pair of overlapping byte ranges, by comparing ranges."""
    both, rows, counts = token_bytes(), [], Counter()
    for text in texts:
        want = (" " + (text or "")).encode()
        a, b, raw_a, raw_b = both(text) if text else ([], [], [], [])
        if b"".join(raw_a) != want or b"".join(raw_b) != want:
            rows.append((0, 0, 0, 0, "", []))
            continue
        ends = []
        for raw in (raw_a, raw_b):
            at = 0
            ends.append([at := at + len(t) for t in raw])
        cuts = sorted(set(ends[0]) & set(ends[1]))
        parts = [([], []) for _ in cuts]
        for which, (ids, side) in enumerate(((a, ends[0]), (b, ends[1]))):
            for i, e in zip(ids, side):
                parts[bisect_left(cuts, e)][which].append(i)
        groups = ["|".join(",".join(map(str, ids)) for ids in part) for part in parts]
        links, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            links.append((a[i], b[j]))
            x, y = ends[0][i], ends[1][j]
            i, j = i + (x <= y), j + (y <= x)
        counts.update(set(links))
        rows.append((len(a), len(b), len(groups), len(links), sha(";".join(groups)), links))
    best = defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    return [(*r[:5], sum(counts[x] == best[x[0]] for x in r[5]), sum(counts[x] for x in r[5])) for r in rows]


ODD_TEXTS = [
    None, "", " ", "  two  spaces ", "\n", "a\n\n b \n", "\ttab", "naïve Übergröße 中文字符 😀😀", "é́ ﬁ x", "<|endoftext|> <s>x</s><0x0A>",
    "▁▁ piece", "\x00zero", "the end", "the end", "antidisestablishmentarianism " * 40, "x" * 5000, "語" * 3000, "a\r\nb", " lead", "don't can't it's",
]


@pytest.mark.parametrize("segment", [aligning.SEGMENT, 3])
def test_alignment(spark, docs, monkeypatch, segment):
    texts = ODD_TEXTS + [r.text for r in docs.select("text").collect()]
    table = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], "doc_id long, text string, block string, n_a int")
    want = [(i, *r) for i, r in enumerate(aligned(texts))]
    if segment == aligning.SEGMENT:
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
        found = aligning.align(table.repartition(3, "doc_id"), BYTE_BPE, PIECES).select(*names)
        assert sorted(map(tuple, found.collect())) == want
    else:
        monkeypatch.setattr(aligning, "SEGMENT", segment)
        worker = aligning.Aligner(BYTE_BPE, PIECES)
        found = worker.align_all([t or '' for t in texts], keep=True)
        assert [(i, m.n_a, m.n_b, m.n_groups, m.n_links, m.digest) for i, m in enumerate(found)] == [r[:6] for r in want]
        assert all(sha(m.groups) == m.digest for m in found if m.n_a)


def test_words_are_forgotten(monkeypatch, docs):
    """A worker that holds next to nothing gives the same tokens."""
    texts = ODD_TEXTS + [r.text for r in docs.select("text").limit(40).collect()]
    want = [m.digest for m in aligning.Aligner(BYTE_BPE, PIECES).align_all([t or "" for t in texts])]
    small = aligning.Aligner(BYTE_BPE, PIECES)
    monkeypatch.setattr(aligning, "REMEMBERED_BYTES", 2_000)
    assert [m.digest for t in texts for m in small.align_all([t or ""])] == want


def test_alignment_of_repeated_and_no_rows(spark, odd):
    assert aligning.align(odd.limit(0), BYTE_BPE, PIECES).count() == 0
    found = aligning.align(odd, BYTE_BPE, PIECES, groups=True)
    assert found.count() == odd.count()
    copies = found.where("doc_id = 4").drop("doc_id").distinct()
    assert copies.count() == 1 and sha(copies.first().groups) == copies.first().groups_sha256


def test_probing():
    a = [1, 2, 3, 4, 5, 6, 7, 9, 12]
    assert aligning.one_to_one(a, a, 0, 0) == 9
    for cut in range(9):
        b = a[:cut] + [a[cut] + 0.5] + a[cut + 1 :]
        assert aligning.one_to_one(a, b, 0, 0) == cut
    long = list(range(1, 200))
    odd = [*range(1, 100), 99.5, *range(100, 200)]
    assert aligning.diagonals(long, odd) == ([(0, 0, 99), (100, 101, 99)], [(99, 99, 100, 101)], [99, 99], [99, 100])
    stretches, groups, left, right = aligning.diagonals([1, 2, 3, 6, 8], [1, 3, 4, 6, 7, 8])
    assert stretches == [(0, 0, 1)] and groups == [(1, 1, 3, 2), (3, 2, 4, 4), (4, 4, 5, 6)]
    assert list(zip(left, right)) == [(1, 1), (2, 1), (3, 2), (3, 3), (4, 4), (4, 5)]


# --- fill in the middle ---


def middle_of(key, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    if not text or any(m in text for m in middles.MARKS) or h[2] % 100 >= rate:
        return key, n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < spm:
        return key, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return key, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


FIM_TEXTS = [
    "a\nb\nc\nd", "a\nb\n", "\n\n\n", "no line end", "<P> in it\nx", "<S\n>\nP>\n<", "é\n中\n😀\nend\n" * 9, "<M>", "x\r\ny z\n\x0bq\n",
    "same line\n" * 30_000, "word " * 40_000 + "\nend", "y" * 200_000, "<\nP>\n<S\n>\n",
]


@pytest.mark.parametrize("rate, spm", [(100, 50), (50, 100), (0, 50)])
def test_middles(spark, docs, odd, rate, spm):
    extra = spark.createDataFrame([(1000 + 50 * k + i, t) for k in range(6) for i, t in enumerate(FIM_TEXTS)], "doc_id long, text string")
    table = docs.select("doc_id", "text").unionByName(odd, allowMissingColumns=True).unionByName(extra, allowMissingColumns=True)
    made = middles.transform(table, rate=rate, spm=spm)
    rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
    assert Counter(map(tuple, made.collect())) == Counter(middle_of(k, t, 7, rate, spm) for k, t in rows)
    back = Counter((r.doc_id, r.restored_sha256) for r in middles.digests(made).collect())
    assert back == Counter((k, sha(t or "")) for k, t in rows)


def test_chunks_follow_content():
    """Whatever lies before a passage, its chunks are found again, and every text is its chunks."""
    import random

    rng = random.Random(3)
    passage = bytes(rng.randrange(256) for _ in range(20_000))
    texts = [passage, b"before" + passage, passage + b"x" * 100_000, b"", b"z" * 10]
    cut = list(middles.chunks_of(b"".join(texts), list(map(len, texts))))
    assert [b"".join(c) for c in cut] == texts
    assert max(len(c) for parts in cut for c in parts) <= middles.LONGEST
    assert len(set(cut[0]) & set(cut[1])) >= len(cut[0]) - 2 and len(cut[0]) > 8


def test_summaries_are_bounded(monkeypatch):
    monkeypatch.setattr(middles, "REMEMBERED_BYTES", 100)
    kept = middles.Summaries()
    for i in range(50):
        assert kept[b"%d\n" % i * 10][1] == len(b"%d\n" % i * 10)
    assert sum(map(len, kept)) <= 100 and kept.held == sum(map(len, kept))


def test_no_rows(spark, docs):
    assert middles.digests(middles.transform(docs.limit(0))).count() == 0


def test_full_memory_keeps_the_words_in_use(monkeypatch):
    """Words of the present texts are not encoded anew when a worker's memory is full."""
    worker, encoded = aligning.Aligner(BYTE_BPE, PIECES), []
    first, more = "qzxavwk qzxbvwk ▁ x", "qzxavwk qzxcvwk"
    want = [aligning.Aligner(BYTE_BPE, PIECES).align_all([text], True)[0].groups for text in (first, more)]
    found = [worker.align_all([first], True)[0].groups]
    parts = worker.a.parts
    monkeypatch.setattr(worker.a, "parts", lambda words: encoded.extend(words) or parts(words))
    monkeypatch.setattr(aligning, "REMEMBERED_BYTES", worker.held)
    worker.align_all(["qzxavwk qzxbvwk"])
    encoded.clear()
    monkeypatch.setattr(aligning, "REMEMBERED_BYTES", 1)
    assert found + [worker.align_all([more], True)[0].groups] == want
    assert encoded == [" qzxcvwk"]


def test_a_word_is_aligned_once(monkeypatch):
    """Texts of known words are put together without going over their tokens again."""
    worker, seen, diagonals = aligning.Aligner(BYTE_BPE, PIECES), [], aligning.diagonals
    texts = ["qzxavwk qzxbvwk don't antidisestablishmentarianism", "qzxbvwk antidisestablishmentarianism qzxbvwk\nqzxavwk"]
    want = aligned(texts)
    worker.align_all(texts[:1])
    monkeypatch.setattr(aligning, "diagonals", lambda a, b: seen.append(a[-1]) or diagonals(a, b))
    found = worker.align_all(texts[1:] + ["qzxbvwk " * 5000 + "qzxavwk"])
    assert seen == [len(" qzxbvwk\nqzxavwk")]
    assert [(m.n_a, m.n_b, m.n_groups, m.n_links, m.digest) for m in found[:1]] == [want[1][:5]]


def test_words_that_only_their_neighbours_complete():
    """Such a text is encoded and aligned as a whole."""
    worker = aligning.Aligner(BYTE_BPE, PIECES)
    want = worker.align_all(["qzxavwk qzxbvwk"], True)[0]
    worker.known[" qzxavwk"], worker.known[" qzxbvwk"] = [("", b"", 0, 0)] * 2
    worker.others[" qzxavwk"], worker.others[" qzxbvwk"] = (b" qzxavwk ", b" qzxavwk"), (b"qzxbvwk", b" qzxbvwk")
    found = worker.align([" qzxavwk", " qzxbvwk"], True)
    assert found.groups == want.groups and found.n_a == want.n_a and found.n_links == want.n_links
    assert found.pairs.tolist() == want.pairs.tolist()
