"""WARC writer and salvage reader: round trips, damage, revisits."""
import hashlib
import io
import random

import pytest

from wattgrid.llm import warc as W
from wattgrid.llm.common import scratch

SCHEMA = "page_id long, url string, html string, file string, _sha string"


class File(io.BytesIO):
    def size(self):
        return len(self.getvalue())

    def read_at(self, n, at):
        return self.getvalue()[at:at + n]


def archive(compress, n=12):
    rng = random.Random(7)
    out = []
    for i in range(n):
        body = bytes(rng.randrange(256) for _ in range(rng.choice([0, 10, 5000])))
        data = W.page_record(i, f"http://x/{i}\n", body, None, None)
        out.append((W.member(data, 6) if compress else data, body))
    return out


@pytest.mark.parametrize("compress", [True, False])
def test_whole_archive(compress):
    parts = archive(compress)
    got = list(W.salvage(File(b"".join(p for p, _ in parts))))
    assert [g[0] for g in got] == ["record"] * len(parts) and [g[4] for g in got] == [b for _, b in parts]


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("how", ["flip", "cut", "noise", "tail", "drop"])
def test_salvage_recovers_all_else(compress, how):
    """One damaged place: every record that it doesn't touch comes back, the gap covers the rest."""
    parts = archive(compress)
    for hurt in (0, 3, len(parts) - 1):
        pieces = [p for p, _ in parts]
        p = pieces[hurt]
        pieces[hurt] = {"flip": p[:len(p) // 2] + bytes([p[len(p) // 2] ^ 1]) + p[len(p) // 2 + 1:], "cut": p[:-7], "noise": b"WARC/1.1 \x1f\x8b\x08 noise" * 9,
                        "tail": p[:25], "drop": p[9:]}[how]
        data = b"".join(pieces)
        got = list(W.salvage(File(data)))
        bodies = [g[4] for g in got if g[0] == "record"]
        want = [b for k, (_, b) in enumerate(parts) if k != hurt]
        assert bodies == want, (how, hurt)
        start = sum(map(len, pieces[:hurt]))
        assert [(g[1], g[2]) for g in got if g[0] == "gap"] == [(start, start + len(pieces[hurt]))]
        assert all(g[3] for g in got if g[0] == "gap")


def test_junk_and_empty():
    assert list(W.salvage(File(b""))) == []
    assert [g[:3] for g in W.salvage(File(b"junk" * 10))] == [("gap", 0, 40)]


def test_mark_across_blocks(monkeypatch):
    monkeypatch.setattr(W, "BLOCK", 64)
    parts = archive(True, 4)
    data = b"j" * 61 + b"".join(p for p, _ in parts)
    got = list(W.salvage(File(data)))
    assert [g[0] for g in got] == ["gap"] + ["record"] * 4


PAGES = [(1, "u1", "x" * 1000), (2, "u2", "x" * 1000), (3, "u3", "x" * 1000), (4, "u4", "y" * 999), (5, "u5", "y" * 999), (6, None, None), (7, "u7", ""),
         (None, "u8", "x" * 1000), (9, "é\r\nX: y", "é" * 500), (10, "u10", "é" * 500), (10, "u10", "é" * 500), (None, "u", "z" * 2000), (None, "u", "z" * 2000)]


@pytest.mark.parametrize("compress", [True, False])
def test_pages_round_trip(spark, compress):
    folder = scratch(spark, "test-warc")
    files = W.write_archives(spark.createDataFrame([(*p, "clash", "clash") for p in PAGES], SCHEMA), folder, compress=compress)
    rows = W.read_archives(files, folder).collect()
    assert all(r["kind"] == "record" for r in rows) and len(rows) == len(PAGES)
    last = {"x" * 1000: 3, "é" * 500: 10}

    def want(p):
        body = (p[2] or "").encode()
        to = last.get(p[2]) if last.get(p[2]) != p[0] else None
        return p[0], len(body), hashlib.sha1(body).hexdigest(), "revisit" if to is not None else "response", to
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=str)
    assert got == sorted(map(want, PAGES), key=str)
    assert {r["url"] for r in rows if r["page_id"] == 9} == {"é%0D%0AX: y"}
    empty = scratch(spark, "test-warc")
    assert W.read_archives(W.write_archives(spark.createDataFrame([], SCHEMA), empty), empty).count() == 0


def test_damage_in_stored_archives_is_quarantined(spark):
    """A byte turned in a stored archive: its record is reported missing, its bytes are in the quarantine table, all else is read."""
    folder = scratch(spark, "test-warc")
    pages = spark.createDataFrame([(i, f"u{i}", f"page {i} " * 50) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    files = W.write_archives(pages, folder)
    fs, top = W.place(folder)
    name = files.collect()[0]["file"]
    with fs.open_input_file(f"{top}/{name}") as f:
        data = f.read()
        starts = [g[1] for g in W.salvage(f)]
    at = (starts[20] + starts[21]) // 2
    hurt = data[:at] + bytes([data[at] ^ 0x55]) + data[at + 1:]
    with fs.open_output_stream(f"{top}/{name}", compression=None) as f:
        f.write(hurt)
    records, gaps, missing = W.read_checked(files, folder)
    assert records.count() == 39 and [tuple(r) for r in missing.collect()] == [(name, 40, 39)]
    got = gaps.collect()
    assert [(r["file"], r["offset"], r["length"]) for r in got] == [(name, starts[20], starts[21] - starts[20])]
    assert bytes(got[0]["bytes"]) == hurt[starts[20]:starts[21]] and got[0]["reason"]


@pytest.mark.parametrize("line", [b"WARC/1.1\r\n", b"WARC/1.1\r\nA: b\r\n", b"A: WARC/1.1\r\n", b"\x1f\x8b\x08"])
def test_flood_of_marks_takes_linear_time(line):
    import time
    good = archive(False, 2)
    start = time.process_time()
    data = line * (400_000 // len(line)) + b"\r\n\r\n" + b"".join(p for p, _ in good)
    got = list(W.salvage(File(data)))
    assert [g[4] for g in got if g[0] == "record"] == [b for _, b in good]
    assert time.process_time() - start < 20


def test_damaged_length_and_bomb_hold_nothing():
    import tracemalloc
    data = W.page_record(1, "u", b"x", None, None)
    bomb = W.member(W.VERSION + b"Content-Length: 300000000\r\n\r\n" + b"0" * 200_000_000, 9)
    tracemalloc.start()
    got = list(W.salvage(File(bomb + data)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [g[0] for g in got] == ["gap", "record"] and peak < 60 << 20


def test_large_payload_is_read_once_it_passed(monkeypatch):
    monkeypatch.setattr(W, "HOLD", 100)
    body = b"0123456789" * 500
    for compress in (True, False):
        data = W.page_record(1, "u", body, None, None)
        got = list(W.salvage(File(W.member(data, 6) if compress else data)))
        assert got[0][4] == body and got[0][5] == (hashlib.sha1(body).hexdigest(), len(body))
