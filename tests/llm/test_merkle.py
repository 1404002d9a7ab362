import hashlib
import zlib

import pytest

from mailsift.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
UPPER = str.maketrans(merkle.UPPER, merkle.LOWER)


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    fields = [doc_id, source, lang, n_chars, text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree_of(nodes):
    """All levels of one tree, by the plain definition."""
    rows = [nodes]
    while len(rows[-1]) > 1:
        rows.append([h("".join(rows[-1][i : i + 8])) for i in range(0, len(rows[-1]), 8)])
    return rows


def path_of(rows, at):
    found = []
    for level in rows[:-1]:
        run = at // 8 * 8
        found.append(("".join(level[run:at]), "".join(level[at + 1 : run + 8])))
        at //= 8
    return found


def plain(rows):
    """Sorted result rows by whole trees in memory."""
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        own = [(r, leaf_of(*r)) for r in rows if r[2] == lang]
        own.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[lang] = own, tree_of([d for _, d in own])
    top = tree_of([trees[v][1][-1][0] for v in langs])
    out = []
    for k, lang in enumerate(langs):
        own, levels = trees[lang]
        for at, (row, digest) in enumerate(own):
            path = path_of(levels, at) + path_of(top, k)
            node = digest
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[1] is not None:
                node = leaf_of(row[0], row[1].translate(UPPER), *row[2:])
            for left, right in path:
                node = h(left + node + right)
            root = top[-1][0]
            proof = h("".join(a + b for a, b in path))
            out.append((str(row[0]), digest, levels[-1][0], root, proof, node, node == root))
    return sorted(out)


def result(spark, rows, schema=DOCS, height=2):
    """By default with superblocks of 64 nodes, so that small tables need several levels of them."""
    found = merkle.manifest(spark.createDataFrame(rows, schema), merkle.lower_cased(), height).collect()
    return sorted((str(r[0]), *r[1:]) for r in found)


def made(n, langs):
    return [(i * 3 % 1009 + i // 1009 * 2000, f"Text {i} Ä\n" * (i % 5), langs[i * i % len(langs)], None if i % 7 == 0 else f"s{i % 3}",
             i) for i in range(n)]


@pytest.mark.parametrize(("n", "height"), [(1, 4), (9, 1), (64, 2), (65, 2), (700, 4)])
def test_one_language(spark, n, height):
    rows = made(n, ["en"])
    assert result(spark, rows, height=height) == plain(rows)


def test_superblocks_of_superblocks(spark):
    rows = made(9_000, ["en"] * 30 + ["de", None, "", "fr"])
    found = result(spark, rows)
    assert found == plain(rows)
    assert {r[-1] for r in found} == {True, False}


def test_many_languages(spark):
    rows = made(400, [f"l{k}ä" for k in range(150)] + [None])
    assert result(spark, rows) == plain(rows)


def test_nulls_ties_repeated_rows_and_clashing_columns(spark):
    rows = [(None, None, None, None, None)] * 90 + [(5, "Same", "en", "s", 4)] * 90 + [(5, "Other", "en", "s", 5)]
    rows += [(None, f"T{i}", "en", None, i) for i in range(20)] + [(2**60 + i, "X" * 100_000, "en", "", None) for i in range(3)]
    wide = [r + ("x", 1, 2) for r in rows]
    assert result(spark, wide, DOCS + ", digest string, pos long, tree int") == plain(rows)


def test_empty_table_and_rows_as_they_are(spark):
    assert result(spark, []) == []
    whole = merkle.manifest(spark.createDataFrame(made(100, ["en", "de"]), DOCS)).collect()
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in whole)
