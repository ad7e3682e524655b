import io
import math
import random
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from stockloom.llm import url_templates, warc
from stockloom.session import stage_folder

PAGES = "page_id bigint, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES)


def test_archives_give_back_all_pages(spark):
    rows = [(i, f"http://a.net/{i}", f"<p>{i % 7} é</p>" * (i % 5)) for i in range(200)]
    rows += [(300, None, None), (301, "http://x/\r\ny", ""), (None, "u", "<p>1 é</p>"), (None, "u", "only here")]
    rows += [(302, "u", "WARC/1.1\r\n" * 50), (302, "u", "WARC/1.1\r\n" * 50), (303, "big", "x" * 3_000_000)]
    found = warc.archived(spark, pages(spark, rows)).collect()
    assert len(found) == len(rows) and all(r.reason is None for r in found)
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    expected = []
    for page_id, _, html in rows:
        body = html or ""
        to = first.get(body)
        revisit = to is not None and to != page_id
        expected.append(
            (page_id, len(body.encode()), warc.digest(body.encode()), "revisit" if revisit else "response", to if revisit else None)
        )
    own = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(own, key=str) == sorted(expected, key=str)


def test_small_payloads_are_never_revisited(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    found = {r.page_id: r.refers_to for r in warc.with_revisits(pages(spark, rows), 3).collect()}
    assert found == {1: None, 2: None, 3: None, 4: 3}


def members(count, packed):
    out = []
    for i in range(count):
        body = f"page {i} ".encode() * (50 + i)
        data = warc.record(i, f"http://a/{i}", body, warc.digest(body), None, False)
        out.append(warc.gzip_member(data) if packed else data)
    return out


def test_salvage_recovers_later_records_and_covers_every_byte():
    choice = random.Random(6)
    for packed in (True, False):
        parts = members(30, packed)
        for _ in range(30):
            damaged = [bytearray(p) for p in parts]
            hit = sorted(choice.sample(range(30), 4))
            for i in hit:
                kind = choice.randrange(4)
                if kind == 0:
                    # Plain headers have no checksum of their own.
                    first = 0 if packed else damaged[i].find(b"\r\n\r\n") + 4
                    damaged[i][choice.randrange(first, len(damaged[i]))] ^= 0xFF
                elif kind == 1:
                    del damaged[i][choice.randrange(1, len(damaged[i])) :]
                elif kind == 2:
                    damaged[i][0:0] = choice.randbytes(40)
                else:
                    damaged[i] = bytearray()
            data = b"".join(damaged)
            found = list(warc.salvage(io.BytesIO(data)))
            at = 0
            for piece in found:
                assert piece.start == at
                at = piece.end
            assert at == len(data)
            ids = [int(f.headers["warc-record-id"][10:-1]) for f in found if f.headers]
            assert set(range(30)) - set(hit) <= set(ids) and ids == sorted(set(ids))


def salvaged(data):
    found = list(warc.salvage(io.BytesIO(data)))
    at = 0
    for piece in found:
        assert piece.start == at
        at = piece.end
    assert at == len(data)
    return [int(f.headers["warc-record-id"][10:-1]) if f.headers else None for f in found]


def test_salvage_keeps_good_records_of_a_damaged_member():
    choice = random.Random(8)
    plain = members(40, False)
    assert salvaged(warc.gzip_member(b"".join(plain))) == [*range(40)]
    damaged = bytearray(plain[20])
    damaged[-10] ^= 0xFF
    one = warc.gzip_member(b"".join([*plain[:20], damaged, *plain[21:]]))
    assert salvaged(one) == [*range(20), None, *range(21, 40)]
    # A wrong CRC, and ends cut off: what was unpacked before is kept, and what follows.
    whole = warc.gzip_member(b"".join(plain[:30]))
    broken = bytearray(whole)
    broken[-6] ^= 0xFF
    tail = warc.gzip_member(plain[35]) + warc.gzip_member(plain[36])
    assert salvaged(bytes(broken) + tail) == [*range(30), None, 35, 36]
    noise = [warc.record(i, "u", choice.randbytes(9000), "", None, False) for i in range(30)]
    cut = warc.gzip_member(b"".join(noise))
    found = salvaged(cut[: len(cut) // 2] + tail)
    assert found[:14] == [*range(14)] and found[-3:] == [None, 35, 36] and len(found) <= 18


def test_headers_of_any_length_are_read(spark):
    rows = [(1, "http://a.net/" + "x" * 200_000, "<p>a</p>"), (2, "http://a.net/2", "<p>b</p>")]
    found = warc.archived(spark, pages(spark, rows)).collect()
    assert {r.page_id: r.url for r in found} == {i: url for i, url, _ in rows}


def test_salvage_of_empty_and_foreign_bytes():
    assert list(warc.salvage(io.BytesIO(b""))) == []
    junk = random.Random(1).randbytes(3_000_000)
    found = list(warc.salvage(io.BytesIO(junk)))
    assert [f.headers for f in found] == [None] and found[0].end == len(junk)


def test_gaps_are_logged_by_the_reader(spark):
    folder = stage_folder(spark, "damaged")
    listed = warc.write_archives(warc.with_revisits(pages(spark, [(i, "u", f"{i}" * 500) for i in range(50)])), folder)
    path = urlparse(listed.first().path).path
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2] ^= 0xFF
    open(path, "wb").write(data)
    found = warc.read_archives(listed).collect()
    gaps = [r for r in found if r.reason is not None]
    assert len(gaps) == 1 and gaps[0].end > gaps[0].start and gaps[0].page_id is None
    assert sum(r.reason is None for r in found) == 49


def test_empty_pages(spark):
    assert warc.archived(spark, pages(spark, [])).count() == 0


RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def test_rules_and_parts_of_urls(spark):
    urls = {
        "http://WWW.Example.NET/en/1?q#f": ("www.example.net", "/en/1", "example.net/en/", "allow"),
        "https://example.net/de/": ("example.net", "/de/", "net/", "block"),
        "https://example.net": ("example.net", "", None, "allow"),
        "ftp://badexample.com/de/x": ("badexample.com", "/de/x", None, "allow"),
        "http://a.example.com/de/x": ("a.example.com", "/de/x", "example.com/de/", "block"),
        "http://x.org/fr/y://z": ("x.org", "/fr/y://z", "org/fr/", "allow"),
        "no scheme/net/": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "http://?x": ("", "", None, "allow"),
    }
    rows = [(i, url, None) for i, url in enumerate(urls)] + [(None, "http://b.net/", None)]
    labels = spark.createDataFrame([], "page_id bigint, bad int")
    frame = pages(spark, rows).withColumn("host", F.col("html"))
    found = url_templates.url_verdicts(frame, labels, RULES).collect()
    assert len(found) == len(rows)
    for row in found:
        if row.page_id is not None:
            expected = list(urls.values())[row.page_id]
            assert (row.host, row.path, row.rule, row.verdict) == expected


def test_bad_templates_are_rejected_and_good_ones_left(spark):
    rows, labels = [], []
    for i in range(200):
        section = ("news", "spam", "blog")[i % 3]
        rows.append((i, f"http://site.com/{section}/user{i}/{i}.html", None))
        if i % 2:
            labels.append((i, int(section == "spam")))
    rows += [(1000 + i, f"http://good.com/p/{i}", None) for i in range(20)]
    rows += [(2000, "http://site.com/spam/new/7.html?x", None), (2001, "http://unseen.com/a", None)]
    frame = spark.createDataFrame(labels + [(None, 1)], "page_id bigint, bad int")
    found = {r.page_id: r for r in url_templates.url_verdicts(pages(spark, rows), frame, RULES).collect()}
    for i in range(200):
        assert found[i].verdict == ("block" if i % 3 == 1 else "allow"), found[i]
    assert found[2000].verdict == "block" and found[2001].verdict == "allow"
    assert all(found[1000 + i].verdict == "allow" for i in range(20))
    assert found[0].template.startswith("site.com/{low}/")
    assert url_templates.url_verdicts(pages(spark, []), frame, RULES).count() == 0


def brute_tree(shapes, settings):
    """{(host, shape): (template, rate)} node by node; shapes are (host, parts, labels, bad)."""
    labels = sum(s[2] for s in shapes)
    overall = sum(s[3] for s in shapes) / labels if labels else 0.0
    out = {}

    def smoothed(bad, held, above):
        return (bad + settings.weight * above) / (held + settings.weight)

    def grow(rows, prefix, depth, rate, held):
        going = [
            r for r in rows
            if len(r[1]) > depth and (depth < settings.depth or held >= settings.labels)
        ]
        for row in rows:
            if row not in going:
                rest = "/**" if len(row[1]) > depth else ""
                out[row[0], "/".join(row[1])] = (row[0] + prefix + rest, rate)
        by_segment = {}
        for row in going:
            by_segment.setdefault(row[1][depth], []).append(row)
        n, b = sum(r[2] for r in going), sum(r[3] for r in going)
        by_token = {}
        for segment, own in by_segment.items():
            k, c = sum(r[2] for r in own), sum(r[3] for r in own)
            difference = (c + 0.5) / (k + 1) - (b - c + 0.5) / (n - k + 1)
            pooled = (b + 1) / (n + 2)
            few = k < settings.labels
            error = few or math.sqrt(pooled * (1 - pooled) * (1 / k + 1 / max(n - k, 1)))
            token = segment
            if len(by_segment) > 1 and (few or abs(difference) < settings.z * error):
                token = "*"
            elif len(by_segment) > 1 and difference < 0:
                token = "{low}"
            by_token.setdefault(token, []).extend(own)
        for token, own in by_token.items():
            k, c = sum(r[2] for r in own), sum(r[3] for r in own)
            same = depth >= settings.depth and k == held
            grow(own, f"{prefix}/{token}", depth + 1, rate if same else smoothed(c, k, rate), k)

    for host in {s[0] for s in shapes}:
        rows = [s for s in shapes if s[0] == host]
        k, c = sum(r[2] for r in rows), sum(r[3] for r in rows)
        grow(rows, "", 0, smoothed(c, k, overall), k)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_tree_equals_brute_force(spark, seed):
    choice = random.Random(seed)
    shapes = {}
    for _ in range(300):
        host = choice.choice(("a.org", "b.org", "b.org"))
        trunk = choice.choice(([], ["s"] * 6, ["s"] * 3 + ["t"], ["x", "y"]))
        tail = [choice.choice("pqr") for _ in range(choice.randrange(5))]
        labels = choice.choice((0, 0, 1, 2, 9))
        bad = labels if "p" in tail else choice.randrange(labels + 1) // 2
        if trunk + tail:
            shapes[host, "/".join(trunk + tail)] = (labels, bad)
    rows, listed = [], []
    for (host, path), (labels, bad) in shapes.items():
        listed.append((host, path.split("/"), labels, bad))
        rows += [(host, f"/{path}", int(k < bad) if k < labels else None) for k in range(labels + 1)]
    urls = spark.createDataFrame(rows, "host string, path string, bad int")
    found = url_templates.template_tree(urls).collect()
    wanted = brute_tree(listed, url_templates.Settings())
    assert {(r.host, r.shape): r.template for r in found} == {k: t for k, (t, _) in wanted.items()}
    for row in found:
        assert row.rate == pytest.approx(wanted[row.host, row.shape][1], rel=1e-9)


def test_long_paths_take_few_rounds(spark, monkeypatch):
    rounds = []
    deeper = url_templates._deeper
    monkeypatch.setattr(url_templates, "_deeper", lambda *a: rounds.append(1) or deeper(*a))
    long = "/".join(["loop"] * 1000)
    rows = [("a.org", f"/{long}/{i % 2}x" if i % 4 else f"/{long}/z", int(i % 2)) for i in range(40)]
    found = url_templates.template_tree(spark.createDataFrame(rows, "host string, path string, bad int"))
    assert len(rounds) <= 3 and found.count() == 2


def test_bad_sections_of_many_equal_ones_and_bad_deep_segments_are_found(spark):
    def name(i):
        return "".join("abcdefghij"[int(c)] for c in str(i))

    rows, labels = [], []
    for section in range(60):
        for i in range(20):
            rows.append((100 * section + i, f"http://wide.com/s{name(section)}/x", None))
            labels.append((100 * section + i, int(section == 7)))
    for i in range(60):
        kind = ("bad", "good")[i % 2]
        rows.append((10_000 + i, f"http://deep.com/a/b/c/d/e/{kind}/{name(i)}", None))
        labels.append((10_000 + i, int(kind == "bad")))
    # Ids with few labels each are one branch still; long paths with few labels stay allowed.
    rows += [(20_000 + i, f"http://ids.com/{name(i)}/{'y/' * 40}", None) for i in range(100)]
    labels += [(20_000, 1), (20_001, 0), (20_002, 0)]
    frame = spark.createDataFrame(labels, "page_id bigint, bad int")
    found = {r.page_id: r for r in url_templates.url_verdicts(pages(spark, rows), frame, {}).collect()}
    assert {i for i, r in found.items() if r.verdict == "block"} == {
        *range(700, 720), *range(10_000, 10_060, 2)
    }
    assert found[20_003].template.startswith("ids.com/*/") and found[20_003].template.endswith("/**")
    assert len({found[20_000 + i].template for i in range(100)}) == 1
