import gzip
import hashlib
import os
import random
import time

import pytest
from pyspark.errors import PySparkException

from mailsift.llm import chat, warc

PAGES = "page_id long, url string, html string, shard string, payload string, refers_to string"


def pages(spark, rows):
    return spark.createDataFrame([r + ("a", "b", "c") for r in rows], PAGES)


def expected(rows):
    out = []
    copies = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000:
            copies.setdefault(data, []).append(page)
    for page, _, html in rows:
        data = (html or "").encode()
        known = [p for p in copies.get(data, []) if p is not None]
        kept = max(known) if known else None
        refers = kept if kept is not None and kept != page else None
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers is not None else "response", refers))
    return out


def read(df):
    return [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()]


def key(row):
    return tuple((v is not None, v) for v in row)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "ID_RANGE", 4)
    rng = random.Random(1)
    bodies = ["", "short", "x" * 999, "y" * 1000, "é" * 700, "z" * 300_000, "WARC/1.1\r\n\r\n" * 200]
    rows = [(i * 37 % 211, f"http://h/{i}\r\n x", rng.choice(bodies + [f"page {i} " * 300])) for i in range(150)]
    rows += [(9_000_000_000, None, None), (-5, "u", "y" * 1000), (None, "n", "y" * 1000), (None, "n", "only null " * 200)]
    found = read(warc.round_trip(pages(spark, rows), shard_rows=16, file_bytes=2_000))
    assert sorted(found, key=key) == sorted(expected(rows), key=key)


def test_files_are_the_same_however_rows_arrive(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"body {i % 50} " * 200) for i in range(300)]
    contents = []
    for n, df in enumerate((pages(spark, rows), pages(spark, rows[::-1]).repartition(7))):
        root = f"file://{tmp_path}/run{n}"
        manifest = warc.write_archives(df, root, file_bytes=4_000, shard_rows=64).collect()
        assert sum(m.records for m in manifest) == 300
        files = {f: (tmp_path / f"run{n}" / f).read_bytes() for f in os.listdir(tmp_path / f"run{n}") if f.endswith(".gz")}
        assert set(files) == {m.name for m in manifest}
        assert not os.listdir(tmp_path / f"run{n}" / "_temporary")
        for m in manifest:
            assert (len(files[m.name]), hashlib.sha1(files[m.name]).hexdigest()) == (m.bytes, m.sha1)
        contents.append(files)
    assert contents[0] == contents[1] and len(contents[0]) > 4
    text = gzip.decompress(next(iter(contents[0].values()))).decode()
    assert text.startswith("WARC/1.1\r\nWARC-Type: ") and "WARC-Block-Digest: sha1:" in text


def test_damage_is_noticed_and_strays_are_not_read(spark, tmp_path):
    root = f"file://{tmp_path}/w"
    (m,) = warc.write_archives(pages(spark, [(1, "u", "hello world")]), root).collect()
    (tmp_path / "w" / "shard-000099-0000.warc.gz").write_bytes(b"stray")
    assert warc.read_archives(spark, root).count() == 1
    file = tmp_path / "w" / m.name
    file.write_bytes(gzip.compress(gzip.decompress(file.read_bytes()).replace(b"hello", b"jello")))
    with pytest.raises(PySparkException):
        warc.read_archives(spark, root).collect()


def test_repeated_rows_and_empty_table(spark):
    rows = [(4, "u", "q" * 1500)] * 3 + [(3, "u", "q" * 1500)]
    found = read(warc.round_trip(pages(spark, rows)))
    assert sorted(f[3] for f in found) == ["response"] + ["revisit"] * 3 and {f[4] for f in found} == {None, 4}
    assert read(warc.round_trip(pages(spark, []))) == []


CHAT = "conv_id long, turn long, role string, text string, turns string, formatted string"


def conversations(spark, rows):
    return spark.createDataFrame([r + ("x", "y") for r in rows], CHAT)


def plain_digests(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(
            ((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv)
        )
        turns = "".join(f"{r}\n{x}\n" for *_, r, x in own)
        loss = "".join(x for *_, r, x in own if r == "assistant")
        out[conv] = (
            len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()
        )
    return out


def test_chat_round_trip(spark):
    rng = random.Random(9)
    parts = list(chat.CONTROL_STRINGS) + ["<", "|", "␛", "␛0", "␛1", "␛2", "\n", "im_end|>", "é😀", " ok ", "[", "INST]", "$1\\E\\Q"]
    rows = [
        (c, t, rng.choice(["user", "assistant", "system"]), "".join(rng.choice(parts) for _ in range(rng.randint(0, 9))))
        for c in range(40) for t in range(rng.randint(1, 9))
    ]
    rows += [(100, 1, "assistant", None), (100, None, None, "x"), (101, 1, "a\nb<|im_end|>", "t"), (None, 1, "user", "q")]
    rows += [(102, 1, "assistant", "same"), (102, 1, "assistant", "same"), (103, 0, "assistant", "long " * 60_000)]
    rows += [(104, t, "assistant" if t % 3 else "user", f"turn {t}") for t in range(1500)]
    df = chat.formatted(conversations(spark, rows))
    found = {r.conv_id: r for r in chat.digests(chat.read_back(df)).collect()}
    expected = plain_digests(rows)
    assert set(found) == set(expected)
    for conv, e in expected.items():
        r = found[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == e, conv
    merged = {r.conv_id: r.formatted for r in df.collect()}
    assert merged[102] == "<|im_start|>assistant\nsame<|turn|>same<|im_end|>\n"
    assert merged[104].count(chat.BLOCK_START) == 1000 and len(merged[104]) == found[104].formatted_chars


def test_chat_of_very_many_turns(spark):
    """Work grows with the turns of a conversation, not with their square."""
    def digested(n):
        rows = [(1, t, "assistant" if t % 3 else "user", f"turn {t} é</s>") for t in range(n)]
        start = time.perf_counter()
        found = chat.digests(chat.read_back(chat.formatted(conversations(spark, rows)))).collect()
        e = plain_digests(rows)[1]
        assert [(r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found] == [e]
        return time.perf_counter() - start

    digested(10)
    assert digested(30_000) < 25


def test_no_control_string_survives_in_a_text(spark):
    texts = ["".join(p) for p in [("</s>", "[INST]"), ("<<SYS>>", "<s>"), ("<|im_", "end|>"), ("<<<SYS>>>>", "[[INST]]")]]
    for row in spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(spark_column()).alias("e"), chat.unescaped(chat.escaped(spark_column())).alias("back")).collect():
        assert row.back == row.t and not any(c in row.e for c in chat.CONTROL_STRINGS)


def spark_column():
    from pyspark.sql import functions as F

    return F.col("t")


def test_chat_of_an_empty_table(spark):
    assert chat.digests(chat.read_back(chat.formatted(conversations(spark, [])))).collect() == []
