"""WARC packages, exact top-k and shards against brute force."""

import hashlib
import io
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cdrmill.llm import shards, topk, warc
from cdrmill.llm.common import attach

PAGES = "page_id long, url string, html string, status string, record_type string"


def page(i, html, url="http://x"):
    return (i, url, html, "extra", "clash")


def test_warc_round_trip(spark):
    same, short = "<p>" + "é" * 60 + "</p>", "<p>hi</p>"
    rows = [page(7, same), page(3, same), page(5, short), page(6, short), page(8, None), page(9, "")]
    rows += [page(3, same), page(None, same), page(11, "x" * 200_000, None), page(12, "a\r\n\r\nb", "http://a\r\nb%0A")]
    read = warc.warc_round_trip(spark.createDataFrame(rows, PAGES)).collect()
    assert len(read) == len(rows)
    by = defaultdict(list)
    for r in read:
        by[r.page_id].append(r)
    assert [(r.record_type, r.refers_to) for r in by[7]] == [("revisit", 3)]
    assert [r.record_type for r in by[3]] == ["response", "response"]
    assert by[None][0].refers_to == 3
    assert by[5][0].record_type == by[6][0].record_type == "response"
    assert by[7][0].payload_bytes == len(same.encode())
    assert by[7][0].payload_digest == hashlib.sha256(same.encode()).hexdigest()
    assert by[8][0].payload_bytes == by[9][0].payload_bytes == 0
    assert by[11][0].url is None and bytes(by[11][0].payload) == b"x" * 200_000
    assert by[12][0].url == "http://a\r\nb%0A" and bytes(by[12][0].payload) == b"a\r\n\r\nb"
    assert warc.warc_round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_zip_directories():
    plain = io.BytesIO()
    with zipfile.ZipFile(plain, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a", b"first")
        with z.open("b", "w", force_zip64=True) as member:
            member.write(b"second")
        z.comment = b"a comment PK\x05\x06 with a marker"

    class Source(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    source = Source(plain.getvalue())
    found = {m.name: source.getvalue()[m.start : m.start + m.size] for m in warc.members(source)}
    assert found == {"a": b"first", "b": b"second"}
    with pytest.raises(ValueError):
        warc.members(Source(b"no zip" * 20))


def test_zip64_directory(monkeypatch):
    # A directory of the large form, which the standard library writes beyond a limit.
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        for name in "abc":
            z.writestr(name, name * 3)

    class Source(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    assert [m.name for m in warc.members(Source(raw.getvalue()))] == ["a", "b", "c"]


def test_package_without_index(spark, tmp_path):
    rows = [{"page_id": i, "url": "u", "html": f"<p>{i}</p>", "record_type": "response",
             "payload_digest": hashlib.sha256(f"<p>{i}</p>".encode()).hexdigest(), "refers_to": None} for i in range(5)]
    path = tmp_path / "p.wacz"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(warc.ARCHIVE_MEMBER, b"".join(warc._record(r) for r in rows))
    places = warc.locate_records(spark.createDataFrame([(str(path),)], "path string"))
    assert {r.page_id for r in warc.read_records(places).collect()} == set(range(5))


VECTORS = "vec_id long, embedding array<float>, label int, vector string"


def brute_top(rows, k=5):
    sound = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in sound:
        if q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in sound if i != q and len(a) == len(b))
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)}
    return out


@pytest.mark.parametrize("block", [2, 2_048])
def test_top_k(spark, block):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(160)]
    rows += [(200 + i, rows[50][1]) for i in range(30)]  # ties
    rows += [(300, None), (350, [1.0, None] + [0.0] * 4), (400, [float("nan")] * 6), (450, [1.0, 2.0]), (None, rows[0][1])]
    rows += [(500, [1e6] * 6), (501, [-1e6] * 6), (550, [])]
    df = spark.createDataFrame([(i, v, 0, "clash") for i, v in rows], VECTORS).repartition(5)
    found = topk.top_k(topk.whole_vectors(df), F.col("vec_id") % 50 == 0, 5, block).collect()
    assert {tuple(r) for r in found} == brute_top(rows)
    assert topk.top_k(topk.whole_vectors(df.limit(0)), F.col("vec_id") % 50 == 0).count() == 0


def test_shards(spark, docs_of):
    texts = [f"text {i} é" for i in range(600)] + [None, "", "x" * 100_000, "same", "same"]
    ids = [*range(603), None, 7]
    rows = shards.assign(docs_of(texts, ids)).collect()
    assert len(rows) == len(texts)
    sizes = Counter((r.size, r.text_crc32) for r in rows)
    assert sizes == Counter((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts)
    for shard in range(8):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots))) and slots
    assert all(r.grown_shard in (r.shard, 8) for r in rows)
    assert 0 < sum(r.grown_shard == 8 for r in rows) < 150
    assert len({r.shard for r in rows if r.doc_id == 7}) == 1
    assert shards.assign(docs_of([])).count() == 0


def test_shard_draws_by_hand(spark):
    """The tree against the same draws in plain Python."""

    def draw(path, weight, key):
        digits = int(hashlib.md5(f"tree|{path}|{key}".encode()).hexdigest()[: shards.DRAW_DIGITS], 16)
        return -np.log((digits + 0.5) / 16**shards.DRAW_DIGITS) / weight

    tree = {"a": {"r": {0: 1.0, 1: 3.0}}, "b": {"s": {2: 2.0}, "t": {3: 1.0, 4: 0.0}}}

    def expect(key):
        weigh = lambda racks: sum(sum(x.values()) for x in racks.values())
        region = min(tree, key=lambda x: draw(x, weigh(tree[x]), key))
        rack = min(tree[region], key=lambda x: draw(f"{region}/{x}", sum(tree[region][x].values()), key))
        leaves = {s: w for s, w in tree[region][rack].items() if w > 0}
        return min(leaves, key=lambda s: draw(f"{region}/{rack}/{s}", leaves[s], key))

    rows = spark.range(400).select("id", shards.shard_of(F.col("id"), tree).alias("s")).collect()
    assert all(r.s == expect(f"k{r.id}") for r in rows)


def test_attach_with_hot_key(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") < 700, F.lit(1)).otherwise(F.col("id")).alias("k"))
    info = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.col("k") * 2)
    found = attach(rows, info, ["k"], "n", 1000, ["id"]).collect()
    assert len(found) == 1000 and all(r.v == 2 * r.k for r in found)
