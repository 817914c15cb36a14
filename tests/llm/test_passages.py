"""Repeated passages: several texts under one id, passages in words across documents, empty tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from isohour.llm import passages

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def remaining_bytes(texts, length):
    """What every text keeps when a string of ``length`` bytes goes that starts anywhere else; equal (id, text) are one."""
    starts = Counter()
    for raw in texts.values():
        starts.update(raw[k : k + length] for k in range(len(raw) - length + 1))
    kept = {}
    for key, raw in texts.items():
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if starts[raw[k : k + length]] > 1:
                gone[k : k + length] = b"\x01" * length
        kept[key] = bytes(b for b, g in zip(raw, gone) if not g)
    return kept


def remaining_words(texts, length):
    """The same in words, where another document must hold the passage."""
    holders = defaultdict(set)
    for key, text in texts.items():
        words = WORD.findall(text)
        for k in range(len(words) - length + 1):
            holders[tuple(words[k : k + length])].add(key)
    kept = {}
    for key, text in texts.items():
        spots = list(WORD.finditer(text))
        words = [m.group() for m in spots]
        hit = [False] * len(words)
        for k in range(len(words) - length + 1):
            if len(holders[tuple(words[k : k + length])]) > 1:
                hit[k : k + length] = [True] * length
        left, at, k = [], 0, 0
        while k < len(words):
            if hit[k]:
                last = k
                while last + 1 < len(words) and hit[last + 1]:
                    last += 1
                left.append(text[at : spots[k].start()])
                at, k = spots[last].end(), last
            k += 1
        kept[key] = "".join(left) + text[at:]
    return kept


def made_up(seed, n, vocabulary, passage):
    """Texts out of few words with shared passages, copies, repeats inside one text and odd white space."""
    rng = random.Random(seed)
    shared = [" ".join(rng.choice(vocabulary) for _ in range(passage + rng.randrange(-3, 9))) for _ in range(4)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            own = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(2, 30)))
            parts.append(rng.choice([own, own, rng.choice(shared), own + " " + own]))
        texts.append(rng.choice([" ", "\n", "  \t"]).join(parts))
    return texts + texts[:3]


@pytest.mark.parametrize("seed", range(3))
def test_passages_in_words_across_documents(spark, seed):
    vocabulary = [f"w{i}é" for i in range(12 if seed else 3)]
    texts = dict(enumerate(made_up(seed, 50, vocabulary, 14)))
    docs = spark.createDataFrame([(i, t, "own", i, 1.5) for i, t in texts.items()], "doc_id long, text string, stamp string, spans int, kept double")
    found = passages.without_repeats(docs, length=10, short=4)
    assert found.columns == docs.columns
    assert {r.doc_id: r.text for r in found.collect()} == remaining_words(texts, 10)
    assert found.where("stamp <> 'own' OR spans <> doc_id").count() == 0


def test_a_passage_twice_in_one_document_stays(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    texts = {1: f"{passage} and {passage}", 2: "other " + " ".join(f"v{i}" for i in range(70)), 3: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.text for r in passages.without_repeats(docs).collect()} == texts
    docs = docs.unionByName(spark.createDataFrame([(4, f"start {passage} end")], docs.schema))
    assert {r.doc_id: r.text for r in passages.without_repeats(docs).collect()} == texts | {1: " and ", 4: "start  end"}


def test_several_texts_under_one_id(spark):
    """Two texts of one id are two documents; the same text twice under one id is one."""
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefghij") for _ in range(150))
    rows = [(1, passage), (1, "x" + passage + "yz"), (2, "q" * 30), (2, "q" * 30), (3, passage[:90] + "tail" * 30), (None, passage), (4, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = passages.deduplicate(docs, length=60, short=24, texts=True)
    want = remaining_bytes({r: (r[1] or "").encode() for r in rows if r[0] is not None}, 60)
    expected = Counter(
        (k, len((t or "").encode()), hashlib.sha256(want.get((k, t), (t or "").encode())).hexdigest(), want.get((k, t), (t or "").encode()).decode())
        for k, t in rows
    )
    assert Counter(tuple(r) for r in found.select("doc_id", "n_bytes", "kept_sha256", "text").collect()) == expected


def test_repeated_rows_alone_are_no_repeat(spark):
    text = " ".join(f"w{i}" for i in range(200))
    docs = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert passages.deduplicate(docs).where("n_removed > 0").count() == 0
    assert {r.text for r in passages.without_repeats(docs).collect()} == {text}


def test_no_rows(spark, docs):
    assert passages.deduplicate(docs.limit(0)).count() == 0
    assert passages.without_repeats(docs.limit(0)).count() == 0


def test_stage_leaves_no_long_passage(spark, docs):
    """After the stage no 50 words stand in two documents that did so before, and other documents are as they were."""
    table = docs.select("doc_id", "text", "lang", "source", "n_chars")
    found = corpus_pipeline.repeated_passages(spark, table, "")
    assert found.columns == table.columns
    texts = {r.doc_id: r.text or "" for r in table.collect()}
    want = remaining_words(texts, corpus_pipeline.PASSAGE_WORDS)
    rows = found.collect()
    assert {r.doc_id: r.text or "" for r in rows} == want
    assert sum(want[k] != t for k, t in texts.items()) > 0 and all(r.n_chars == len(want[r.doc_id]) for r in rows if want[r.doc_id] != texts[r.doc_id])
