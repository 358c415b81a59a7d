"""WARC archives: round trips, hand-made archives, broken ones."""

import glob
import gzip
import hashlib
import os
import random
import tempfile

import pytest

from greenledger.llm.warc import archived, chunked, read_pages, records_of, resolved, unchunked, write_pages

SCHEMA = "page_id long, url string, html string, sha string, row int, Payload string"


def pages(n=60, seed=4):
    rng = random.Random(seed)
    text = lambda size: "".join(rng.choice("abcé日\r\n 0;WARC/1.1") for _ in range(size))
    out = [(i, f"http://h/{i}", text(rng.choice([0, 10, 999, 1000, 5000, 40000]))) for i in range(n)]
    hot = text(1500)
    out += [(1000 + i, f"http://copy/{i}", hot) for i in range(40)]
    out += [(1039, "http://copy/again", hot), (None, "u", hot), (None, None, None), (7, "http://h/7", out[7][2]),
            (-1, "a b\r\nX: y %41", "short"), (-2, None, "short"), (-3, "e", ""), (-4, "utf", "é" * 500), (-5, "utf", "é" * 500),
            (-6, "s", "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 60)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, u, t, "s", 1, "p") for i, u, t in rows], SCHEMA).repartition(3)


def expected(rows):
    """(page_id, bytes, sha1) of each row; (type, refers_to) as a multiset per payload."""
    groups = {}
    for i, _, t in rows:
        groups.setdefault((t or "").encode(), []).append(i)
    out = []
    for payload, ids in groups.items():
        fixed = len(payload), hashlib.sha1(payload).hexdigest()
        ids.sort(key=lambda i: (i is not None, i or 0))
        for n, i in enumerate(ids):
            again = len(payload) >= 1000 and n < len(ids) - 1
            out.append((i, *fixed, "revisit" if again else "response", ids[-1] if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [{}, {"segment": 700, "chunk": 300, "archive": 9000}])
def test_round_trip(spark, sizes):
    rows = pages()
    got = archived(frame(spark, rows), **sizes)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows)


def test_files_are_bounded_gzip_archives_and_give_the_texts_back(spark, tmp_dir):
    rows = pages()
    path = os.path.join(tmp_dir, "a")
    write_pages(frame(spark, rows), path, segment=700, chunk=300, archive=9000)
    files = glob.glob(path + "/*.gz")
    assert len(files) > 20
    kinds = set()
    for f in files:
        data = gzip.open(f).read()
        assert len(data) < 9000 + 3 * 1200
        found = list(records_of(data))
        assert found[0][0]["warc-type"] == "warcinfo"
        kinds |= {fields["warc-type"] for fields, _ in found}
        assert all(len(block) <= 700 for _, block in found)
    assert kinds == {"warcinfo", "response", "continuation", "revisit"}
    read = read_pages(spark, path)
    texts = sorted(r["payload"].decode() for r in read.filter("record_type = 'response'").collect())
    small = [t or "" for _, _, t in rows if len((t or "").encode()) < 1000]
    assert texts == sorted(small + list({t for _, _, t in rows if len((t or "").encode()) >= 1000}))
    assert not read.filter("problem IS NOT NULL").count()
    uri = read.filter("page_id = '-1'").first()["target_uri"]
    assert uri == "a%20b%0D%0AX:%20y%20%2541"


def test_empty_table(spark):
    got = archived(frame(spark, []))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] and not got.count()


def test_chunked_framing():
    for body in (b"", b"x", b"0\r\n\r\n", os.urandom(5000)):
        for size in (1, 7, 4096):
            assert unchunked(chunked(body, size)) == body
    assert unchunked(b"3;name=v\r\nabc\r\nA\r\n0123456789\r\n0\r\nTrailer: x\r\n\r\n") == b"abc0123456789"
    for bad in (b"", b"3\r\nabc", b"3\r\nabcd\r\n0\r\n\r\n", b"-1\r\n\r\n", b"zz\r\n\r\n", b"3\r\nabc\r\n", b"0\r\n", b"5\r\nabc\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            unchunked(bad)


def rec(kind, rid, block, **fields):
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {rid}"] + [f"{k.replace('_', '-')}: {v}" for k, v in fields.items()]
    return ("WARC/1.0\r\n" + "\r\n".join(lines) + f"\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


def segments(rid, block, size, total=None, order=None):
    cut = [block[i:i + size] for i in range(0, len(block), size)]
    out = [rec("response", rid, cut[0], WARC_Segment_Number=1)]
    for n, c in enumerate(cut[1:], 2):
        last = {"WARC_Segment_Total_Length": len(block) if total is None else total} if n == len(cut) else {}
        out.append(rec("continuation", f"{rid}-{n}", c, WARC_Segment_Origin_ID=rid, WARC_Segment_Number=n, **last))
    return out


def test_foreign_archives_in_any_order_and_broken_ones(spark):
    plain = b"HTTP/1.1 200 OK\r\nContent-Length: 9\r\n\r\n<p>\r\n\r\n</"
    framed = b"HTTP/1.1 200 OK\r\ntransfer-encoding: Chunked\r\n\r\n" + chunked(b"0123456789" * 30, 16)
    many = segments("<many>", framed, 20)  # more than nine segments: ordered as numbers
    random.Random(1).shuffle(many)
    gone = segments("<gone>", framed, 50)
    twice = segments("<twice>", framed, 50)
    other = segments("<other>", framed, 50, total=len(framed) + 1)
    files = {
        "a.warc": rec("warcinfo", "<i>", b"x") + rec("response", "<plain>", plain, X_Page_ID=5) + b"".join(many[:7]),
        "b.warc.gz": b"".join(gzip.compress(r) for r in many[7:]) + gzip.compress(rec("request", "<q>", b"GET /")),
        "c.warc": b"".join(gone[:2] + gone[3:]) + b"".join(twice + twice[1:2]) + b"".join(other),
        "d.warc": rec("response", "<head>", b"no head") + rec("response", "<sum>", plain, WARC_Payload_Digest="sha1:ABC")
        + rec("revisit", "<again>", b"HTTP/1.1 200 OK\r\n\r\n", WARC_Refers_To="<plain>")
        + rec("revisit", "<lost>", b"HTTP/1.1 200 OK\r\n\r\n", WARC_Refers_To="<nowhere>")
        + rec("continuation", "<c>", b"zz", WARC_Segment_Origin_ID="<never>", WARC_Segment_Number=2),
        "e.warc": rec("response", "<before>", plain) + rec("response", "<cut>", plain)[:-10] + b"",
        "f.warc": b"garbage", "g.warc": b"", "h.warc.gz": gzip.compress(rec("response", "<z>", plain))[:-12],
    }
    folder = tempfile.mkdtemp(prefix="gl-warc-")
    for name, data in files.items():
        with open(os.path.join(folder, name), "wb") as f:
            f.write(data)
    got = {r["record_id"] or r["problem"].split("/")[-1].split(":")[0]: r for r in read_pages(spark, folder).collect()}
    assert got["<many>"]["payload"] == b"0123456789" * 30 and got["<many>"]["problem"] is None
    assert got["<plain>"]["payload"] == b"<p>\r\n\r\n</" == got["<before>"]["payload"] and got["<plain>"]["page_id"] == "5"
    problems = {k: r["problem"] for k, r in got.items() if r["problem"]}
    assert problems.pop("<gone>") == problems.pop("<twice>") == "segments missing or repeated"
    assert "total length" in problems.pop("<other>") and "HTTP head" in problems.pop("<head>")
    assert "digest" in problems.pop("<sum>") and "first record" in problems.pop("<never>")
    assert "cut off" in problems.pop("e.warc") and "cut off" in problems.pop("h.warc.gz") and "byte 0" in problems.pop("f.warc")
    assert not problems and all(r["payload"] is None for r in got.values() if r["problem"])
    links = {r["record_id"]: r for r in resolved(read_pages(spark, folder)).collect()}
    assert links["<again>"]["refers_to"] == "5" and links["<again>"]["payload_bytes"] == 9
    assert "not found" in links["<lost>"]["problem"]
