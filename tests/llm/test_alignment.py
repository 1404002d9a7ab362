import hashlib
import random
import sys
from collections import Counter

import pytest

from mailsift.llm import alignment
from mailsift.llm.common import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [" ", "  ", "\n", "\t", "a", "foo", "Foo,", "\xa0", "　", "\x85", "\x1c", "'s", "'ll", "é", "日本", "😀", "1", "23", "...",
       "​", "\r\n", "</s>", "<|endoftext|>", "\x0b", "́", "_", "ﬁ", "<0x0A>", "\x00"]


@pytest.fixture(scope="module")
def both():
    return alignment.Pair(alignment.TOKENIZER_A, alignment.TOKENIZER_B)


def plain_text(both, text):
    """(n_a, n_b, groups, links) of a whole text by comparing every pair of tokens."""
    if not text:
        return 0, 0, [], []
    a, b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    a_parts, b_parts = [both.a_bytes[i] for i in a], [both.b_bytes[i] for i in b]
    whole = (" " + text).encode()
    if b"".join(a_parts) != whole or b"".join(b_parts) != whole:
        return 0, 0, [], []
    a_ends = [len(b"".join(a_parts[: i + 1])) for i in range(len(a))]
    b_ends = [len(b"".join(b_parts[: i + 1])) for i in range(len(b))]
    common = [e for e in a_ends if e in b_ends]
    groups = [
        ([t for t, e in zip(a, a_ends) if low < e <= high], [t for t, e in zip(b, b_ends) if low < e <= high])
        for low, high in zip([0, *common], common)
    ]
    return len(a), len(b), groups, [(t, u) for t, e in zip(a, a_ends) for u, f in zip(b, b_ends) if e == f]


def plain(both, rows):
    parts = [plain_text(both, r[1]) for r in rows]
    counts = Counter(link for p in parts for link in p[3])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for row, (n_a, n_b, groups, links) in zip(rows, parts):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        best = sum(counts[x] == most[x[1]] for x in links)
        digest = hashlib.sha256(text.encode()).hexdigest() if n_a else ""
        out.append((str(row[0]), n_a, n_b, len(groups), len(links), best, sum(counts[x] for x in links), digest))
    return sorted(out)


def result(spark, rows, schema=DOCS, **more):
    found = alignment.align(spark.createDataFrame(rows, schema), **more).collect()
    return sorted((str(r[0]), *r[1:]) for r in found)


def docs(texts):
    return [(i, t, "en", "s", None) for i, t in enumerate(texts)]


def test_stretches_give_what_whole_texts_give(both):
    draw = random.Random(3)
    for _ in range(1500):
        text = "".join(draw.choice([*ODD, "▁"] if draw.random() < 0.1 else ODD) for _ in range(draw.randint(1, 14)))
        n_a, n_b, groups, links = plain_text(both, text)
        found = next(both.rows([text]))
        said = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        assert found[:4] == (n_a, n_b, len(groups), hashlib.sha256(said.encode()).hexdigest() if n_a else ""), text
        counts = Counter((a << alignment.B_BITS) | b for a, b in links)
        assert dict(zip(found[4].tolist(), found[5].tolist())) == counts


@pytest.mark.parametrize("hot", [0, 3, alignment.HOT])
def test_counts_over_the_corpus(spark, both, hot):
    draw = random.Random(9)
    rows = docs(["".join(draw.choice(ODD) + " " * (draw.random() < 0.5) for _ in range(60)) for _ in range(60)])
    assert result(spark, rows, hot=hot) == plain(both, rows)


def test_documents_of_the_table(spark, both):
    given = table(spark, "/root/testdata/sf0.001", "documents").limit(120).collect()
    rows = [tuple(r) for r in given if len(r["text"] or "") < 4_000]
    assert result(spark, rows) == plain(both, rows)


def test_nulls_repeated_rows_long_texts_and_clashing_columns(spark, both):
    rows = docs([None, "", " ", "one two", "▁ not spelt", "Same text", "x" * 3_000, "ab " * 2_000])
    rows += [(None, "Same text", None, None, None)] * 5 + [(3, "one two", "en", "s", 1)] * 2
    wide = [r + (1, "k", 2) for r in rows]
    assert result(spark, wide, DOCS + ", row int, keys string, n_a long") == plain(both, rows)
    assert result(spark, []) == []


def test_forgetting_changes_nothing(both, monkeypatch):
    texts = [f"word{i} and word{i % 7}, {'long' * 80}" for i in range(50)]
    once = [r[:4] for r in both.rows(texts)]
    monkeypatch.setattr(alignment, "KEPT", 5)
    assert [next(both.rows([t]))[:4] for t in texts] == once


def test_learning_a_stretch_takes_few_calls(both):
    text, calls = " ".join(f"word{i}" for i in range(5_000)), 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    next(both.rows(["warmed up"]))
    sys.setprofile(count)
    try:
        next(both.rows([text]))
    finally:
        sys.setprofile(None)
    assert calls < 4 * 5_000
