import itertools
import random
import re

import numpy as np

from mailsift.llm import decontaminate as D

ITEM = (
    "In the morning Tom Smith has 3 apples and Mary Jones gives him 5 km of string so how many apples "
    "does Tom Smith have after 3 days"
)


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc_id string")


def found(docs, items):
    return {(r.doc_id, r.item_id) for r in D.leaks(docs, items).collect()}


def test_reworded_numbers_names_and_case_are_found(spark, documents):
    other = ITEM.replace("Tom Smith", "Bob Lee").replace("3", "14").replace("Mary Jones", "Ann Roy")
    torn = "In the morning Bob Lee has 4 apples and Ann Roy gives him 7 km"
    rows = [
        (1, f"Well. {ITEM}? Yes", "s"), (2, f"Well. {other}? Yes", "s"), (3, ITEM.upper(), "s"),
        (4, ITEM.replace(" ", "\t ") * 3, "s"), (5, other.replace("5 km", "5.5km"), "s"),
        (6, "In the morning there are many apples and so on for 3 days", "s"), (7, "", "s"), (8, None, "s"),
        (9, "7 km " * 40, "s"), (10, torn.split(" has")[0], "s"), (11, "x " * 100_000 + ITEM, "s"),
    ]
    docs = documents(rows, item_id="i", hash="h", doc="d", _id="e", _doc="f")
    items = bench(spark, [(7, ITEM, "x"), (8, None, "x"), (9, "", "x"), (10, "5 km 7 km 9 km", "x")])
    leaking = {1, 2, 3, 4, 5, 11}
    assert found(docs, items) == {(i, 7) for i in leaking}
    kept = D.clean_documents(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, *_ in rows} - leaking


def test_contradicting_values_end_a_run():
    def window(at, *pairs):
        values = dict(pairs)
        return {"at": at, "item_values": [k for k in range(1, 9)], "doc_values": [values.get(k, 0) for k in range(1, 9)]}

    same = [window(i, (1, 11), (2, 12)) for i in range(6)]
    assert D.longest_run(same, 8) == (13, 13)
    other = same[:3] + [window(i, (1, 99)) for i in range(3, 6)]
    assert D.longest_run(other, 8) == (10, 10)
    assert D.longest_run(same[:2] + same[4:], 8) == (9, 13)


def test_slot_consistency_rejects_a_mixed_up_question(spark, documents):
    item = "first 11 red then 22 blue then 11 red then 22 blue then 11 red then 22 blue balls"
    good = item.replace("11", "7").replace("22", "8")
    bad = "first 1 red then 2 blue then 3 red then 4 blue then 5 red then 6 blue balls"
    docs = documents([(1, good, "s"), (2, bad, "s")])
    assert found(docs, bench(spark, [(1, item, "")])) == {(1, 1)}


def test_short_items_repeated_ids_and_empty_tables(spark, documents):
    docs = documents([(1, "we ask: what is love today", "s"), (1, "nothing here", "s"), (None, "What is love", "s")])
    items = bench(spark, [(1, "What is love?", ""), (1, "What is love?", ""), (2, "is love", "")])
    assert found(docs, items) == {(1, 1), (1, 2), (None, 1), (None, 2)}
    assert [r.text for r in D.clean_documents(docs, items).collect()] == ["nothing here"]
    assert found(documents([]), items) == set() and found(docs, bench(spark, [])) == set()
    assert D.clean_documents(docs, bench(spark, [])).count() == 3


def test_filter_never_drops(spark):
    keys = np.random.default_rng(0).integers(-(1 << 63), 1 << 63, 500, dtype=np.int64)
    packed = D._filter_of(spark.createDataFrame([(int(k),) for k in keys], "hash long"))
    bits = np.unpackbits(packed)
    assert bits[(keys.view(np.uint64) >> np.uint64(64 - D.FILTER_BITS)).astype(np.int64)].all()


def test_names_that_open_sentences_are_replaced(spark, documents):
    item = "Alice has 12 red pens. Bob has 7 more pens. Carol has 5 fewer pens. How many pens?"
    other = item.replace("Alice", "Dave").replace("Bob", "Emma").replace("Carol", "Frank").replace("12", "30")
    mixed = "Alice has 12 red pens. Alice has 7 more pens. Carol has 5 fewer pens."
    short = "Alice has 12 pens and buys 5 more."
    rows = [(1, other, "s"), (2, short.replace("Alice", "Dave").replace("12", "4"), "s"), (3, "Well. " + other, "s"),
            (4, item, "s"), (5, other.replace("Emma", "Dave"), "s"), (6, item.lower(), "s")]
    items = bench(spark, [(1, item, ""), (2, short, ""), (3, mixed, "")])
    got = found(documents(rows), items)
    assert {(1, 1), (2, 2), (3, 1), (4, 1), (6, 1)} <= got and not {(i, 2) for i in (1, 3, 4, 5, 6)} & got


def plain_tokens(text):
    """(value, number or unit, name, opens a sentence) of each token."""
    made, opens = [], True
    split = re.sub(r"(?<=\d)([+=-])(?=\d)", r" \1 ", re.sub(r"(?<=\d)(?=[a-z])", " ", text)).split()
    for i, word in enumerate(split):
        core = word.strip(".?+-=!")
        sign = word in "+=" or word == "-" and all(
            0 <= j < len(split) and split[j].strip(".?!").isdigit() for j in (i - 1, i + 1)
        )
        if sign:
            made.append((word, "", False, opens))
        if core:
            number = core.isdigit()
            unit = core.lower() in D.UNITS and bool(made) and made[-1][1] == "number"
            kind = "number" if number else "unit" if unit else ""
            made.append((core.lower(), kind, core[0].isupper() and core[1:].islower(), opens))
        opens = word[-1] in ".?!"
    return made


def plain_windows(tokens, size):
    """(start, template, values) of every window in every reading."""
    made = set()
    for start in range(len(tokens) - size + 1):
        part = tokens[start : start + size]
        for names in (lambda t: False, lambda t: t[2] and not t[3], lambda t: t[2]):
            kinds = [t[1] or ("name" if names(t) else "") for t in part]
            if sum(map(bool, kinds)) * 2 <= size:
                template = tuple("<" + k if k else t[0] for t, k in zip(part, kinds))
                made.add((start, template, tuple(t[0] if k else 0 for t, k in zip(part, kinds))))
        if sum(bool(t[1]) for t in part) * 2 > size:
            made.add((start, tuple(t[0] for t in part), (0,) * size))
    return made


def agree(pairs):
    """Whether each value of the item stands for one value of the document."""
    return all(b == d for (a, b), (c, d) in itertools.combinations(pairs, 2) if a == c)


def plain_runs(laid):
    """(first, last, pairs) of every run of windows that some choice of readings makes consistent."""
    made = []
    for first in laid:
        for last in itertools.takewhile(laid.__contains__, itertools.count(first)):
            choices = itertools.product(*[laid[at] for at in range(first, last + 1)])
            good = [c for c in ({p for pairs in choice for p in pairs} for choice in choices) if agree(sorted(c))]
            if good:
                made.append((first, last, min(good, key=len)))
    return made


def plain_leak(text, item):
    words = plain_tokens(item)
    size = min(D.WINDOW, len(words))
    laid = {}
    for at, template, values in plain_windows(words, size):
        for start, other, said in plain_windows(plain_tokens(text), size):
            if template == other:
                pairs = frozenset((a, b) for a, b in zip(values, said) if a and b)
                laid.setdefault(start - at, {}).setdefault(at, set()).add(pairs)
    for place in laid.values():
        runs = plain_runs(place)
        whole = [r for r in runs if not any(o[0] <= r[0] and r[1] <= o[1] and o[:2] != r[:2] for o in runs)]
        together, covered = set(), set()
        for first, last, pairs in sorted(whole, key=lambda r: (r[0] - r[1], r[0])):
            if agree(sorted(together | pairs)):
                together |= pairs
                covered |= set(range(first, last + size))
        longest = max((last - first + size for first, last, _ in runs), default=0)
        if longest >= min(D.RUN, len(words)) or len(covered) >= D.COVERED * len(words):
            return True
    return False


def test_leaks_equal_brute_force_with_number_heavy_items(spark, documents):
    rng = random.Random(3)
    pick = lambda: rng.choice(["red", "pens", "has", "and", "km", "Alice", "Bob", "7", "12", "30", "+", "-", "5km", "so."])
    items = ["What is 12 + 7 - 5 + 30 ?", "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16", "5 km 7 km 9 km"]
    items += [" ".join(pick() for _ in range(rng.randint(3, 20))) for _ in range(12)]
    texts = [f"so we ask. {t} yes" for t in items] + ["What is 1 + 2 - 3 + 4 ?", "7 km 5 km 9 km", "21 22 23 24 25 26 27 28 29"]
    for t in items:
        texts.append(t.replace("12", "40").replace("Alice", "Carol"))
        texts.append(" ".join(pick() for _ in range(40)))
    got = found(documents([(i, t, "s") for i, t in enumerate(texts)]), bench(spark, [(i, t, "") for i, t in enumerate(items)]))
    assert got == {(d, i) for d, t in enumerate(texts) for i, item in enumerate(items) if plain_leak(t, item)}
    assert {(0, 0), (1, 1), (2, 2)} <= got and (len(items), 0) in got


def test_arithmetic_with_other_numbers(spark, documents):
    item = "What is 12 + 7 - 5 + 30 = 44 ?"
    rows = [(1, "we ask: what is 3+4-5+6=8?", "s"), (2, "What is 3 - 4 + 5 + 6 = 8 ?", "s"),
            (3, "What is 3 4 5 6 8 ?", "s"), (4, "- what is - 3 + 4 - 5 + 6 = 8", "s"), (5, "1 + 2 - 3 + 4", "s")]
    items = bench(spark, [(1, item, ""), (2, "7 + 7 - 5 + 7", "")])
    # In item 2 one number is said three times: other numbers have to agree there too.
    assert found(documents(rows), items) == {(1, 1), (4, 1)}


def test_a_contradiction_at_the_start_of_a_run_leaves_what_follows():
    def window(at, *pairs):
        return {"at": at, "item_values": [a for a, _ in pairs], "doc_values": [b for _, b in pairs]}

    matches = [window(0, (1, 11)), *[window(at, (2, 12)) for at in (1, 2, 3)], window(4, (1, 99)), window(5, (1, 99))]
    assert D.longest_run(matches, 8) == (12, 12)
