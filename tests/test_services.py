"""Map servers: images read and written, retries and refusals, the data source's requests, the store of replies, HTTP on this machine."""

import http.server
import json
import threading
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hypsogrid.operators.grid import TileGrid
from hypsogrid.plans.services import FormulaTransport, client
from hypsogrid.sources import images, services
from hypsogrid.sources.replies import ReplyStore
from hypsogrid.sources.services import Client, HttpTransport, Reply, ServiceError, ServiceSource, checked_heights, height_service, imagery_service, read_service, render

GRID = TileGrid(-900_000.0, -930_000.0, 64, 2.0)


@pytest.mark.parametrize("deflate", [False, True])
def test_tiff_round_trip(deflate):
    v = np.arange(12, dtype=np.float32).reshape(3, 4)
    v[1, 2] = np.nan
    body = images.encode_tiff(v, 10.0, 20.0, 2.0, 5514, -9999.0, deflate)
    r = images.decode_tiff(body)
    assert np.array_equal(r.values, v, equal_nan=True) and (r.west, r.north, r.pixel_x, r.pixel_y, r.epsg, r.nodata) == (10.0, 20.0, 2.0, 2.0, 5514, -9999.0)
    assert np.array_equal(checked_heights(body, (10.0, 14.0, 18.0, 20.0), 4, 3, 5514), v, equal_nan=True)
    for wrong in ((10.0, 14.0, 18.0, 20.0, 3, 4, 5514), (10.0, 14.0, 18.0, 20.0, 4, 3, 4326), (12.0, 14.0, 20.0, 20.0, 4, 3, 5514), (10.0, 16.0, 18.0, 22.0, 4, 3, 5514), (10.0, 11.0, 22.0, 20.0, 4, 3, 5514)):
        with pytest.raises(images.ImageError):
            checked_heights(body, wrong[:4], *wrong[4:])
    for n in range(0, len(body), 7):
        try:
            images.decode_tiff(body[:n])
        except images.ImageError:
            pass


@pytest.mark.parametrize("bands", [3, 4])
def test_png_round_trip(bands):
    p = np.random.default_rng(1).integers(0, 256, (5, 7, bands)).astype(np.uint8)
    got = images.decode_png(images.encode_png(p))
    assert np.array_equal(got[:, :, :bands], p) and (bands == 4 or (got[:, :, 3] == 255).all())
    body = bytearray(images.encode_png(p))
    body[40] ^= 1
    with pytest.raises(images.ImageError):
        images.decode_png(bytes(body))


@pytest.mark.parametrize("how", range(5))
def test_png_filters(how):
    """Lines filtered by the rules of the format, each from the true bytes to its left and above."""
    p = np.random.default_rng(how).integers(0, 256, (4, 6, 4)).astype(int)
    lines = b""
    for r in range(4):
        out = np.zeros((6, 4), int)
        for c in range(6):
            left, up, corner = (p[r, c - 1] if c else np.zeros(4, int)), (p[r - 1, c] if r else np.zeros(4, int)), (p[r - 1, c - 1] if r and c else np.zeros(4, int))
            paeth = [min((abs(int(a + b - d) - int(x)), i, int(x)) for i, x in enumerate((a, b, d)))[2] for a, b, d in zip(left, up, corner)]
            out[c] = (p[r, c] - [np.zeros(4, int), left, up, (left + up) // 2, np.array(paeth)][how]) % 256
        lines += bytes([how]) + out.astype(np.uint8).tobytes()
    plain = images.encode_png(p)
    at = plain.index(b"IDAT") - 4
    data = zlib.compress(lines)
    chunk = len(data).to_bytes(4, "big") + b"IDAT" + data + zlib.crc32(b"IDAT" + data).to_bytes(4, "big")
    assert np.array_equal(images.decode_png(plain[:at] + chunk + plain[plain.index(b"IEND") - 4 :]), p)


class Script:
    """Replies in order; an exception is raised."""

    def __init__(self, *replies):
        self.replies, self.asked = list(replies), 0

    def get(self, url, params, timeout_s):
        self.asked += 1
        r = self.replies.pop(0)
        if isinstance(r, Exception):
            raise r
        return r


OK, BUSY = Reply(200, "image/tiff", b"x"), Reply(503, "", b"busy")


def test_retries():
    waits = []
    fetch = lambda *replies, **k: Client(Script(*replies), 3, 1.0, 1.5, waits.append).fetch("http://x", {"bbox": "1"}, **k)
    assert fetch(BUSY, TimeoutError(), OK) == b"x" and waits == [1.5, 3.0]
    assert fetch(Reply(200, "", b""), ConnectionResetError(), OK) == b"x"
    for last in (BUSY, TimeoutError("t"), Reply(200, "", b"")):
        with pytest.raises(ServiceError, match="3 times"):
            fetch(last, last, last)
    refusing = Script(Reply(404, "", b"no"), OK)
    with pytest.raises(ServiceError, match="404"):
        Client(refusing, 3).fetch("http://x", None)
    assert refusing.asked == 1
    with pytest.raises(ServiceError, match="refused"):
        fetch(Reply(200, "application/json", b"{}"))
    assert fetch(Reply(200, "application/json", b"{}"), expect_json=True) == b"{}"


def test_render_refuses_what_was_not_asked_for():
    box = (0.0, 0.0, 4.0, 2.0)
    extent = {"xmin": 0.0, "ymin": 0.0, "xmax": 4.0, "ymax": 2.0}
    run = lambda reply: render(Client(Script(Reply(200, "application/json", json.dumps(reply).encode()), OK)), "http://x", {"bbox": "b"}, box, 4, 2)
    assert run({"href": "y", "extent": extent}) == b"x" and run({"href": "y", "width": 4, "extent": extent | {"xmin": 0.2}}) == b"x"
    for bad in ([], {"error": "busy", "href": "y", "extent": extent}, {"extent": extent}, {"href": "y"}):
        with pytest.raises(ServiceError):
            run(bad)
    for bad in ({"width": 5}, {"extent": extent | {"xmin": 0.3}}, {"extent": {"xmin": 0}}, {"extent": extent | {"spatialReference": {"wkid": 3857}}}):
        with pytest.raises(images.ImageError):
            run({"href": "y", "extent": extent} | bad)


def test_data_source_asks_for_what_is_wanted(spark):
    service = height_service(client(), "http://made.up/heights", GRID)
    want = {(c, r) for c in range(5, 9) for r in range(8, 20) if (c + r) % 7}
    cut = lambda df: df.where("col > 4 and col <= 8 and row >= 8 and row < 20")
    assert {(x["col"], x["row"]) for x in cut(read_service(spark, service, (0, 0, 20, 40), 8)).collect()} == want
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = cut(read_service(spark, service, (0, 0, 20, 40), 8))
        assert {(x["col"], x["row"]) for x in df.collect()} == want
        assert df.rdd.getNumPartitions() == 2 and read_service(spark, service, (0, 0, 20, 40), 8).rdd.getNumPartitions() == 15
        v = {(x["col"], x["row"]): x["v"] for x in df.collect()}
        assert v[5, 8] == np.float32(0.25 * 5 - 0.125 * 8 + 100)
        assert cut(df).where("col > 100").count() == 0
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    with pytest.raises(Exception, match="status 404"):
        read_service(spark, height_service(Client(refusing()), "http://made.up", GRID), (0, 0, 2, 2)).collect()


def refusing():
    class Refusing:  # local, so that its code goes to the tasks, which cannot import the tests
        def get(self, url, params, timeout_s):
            return Reply(404, "text/plain", b"no")

    return Refusing()


def test_store_of_replies(spark, tmp_path):
    store = ReplyStore(f"file://{tmp_path}/replies")
    windows = spark.createDataFrame([(i, 4 * i, 2, 4, 3) for i in range(6)], "window_id int, col_min long, row_min long, width int, height int")
    source = ServiceSource(height_service(client(), "http://made.up/heights", GRID), store)
    first = source.read(windows.where("window_id < 3")).count()
    assert store.entries(spark).count() == 3
    dead = ServiceSource(height_service(Client(refusing()), "http://made.up/heights", GRID), store)
    assert dead.read(windows.where("window_id < 3")).count() == first  # all from the store
    with pytest.raises(Exception, match="status 404"):
        dead.read(windows)
    assert store.entries(spark).count() == 3 and not [p for p in (tmp_path / "replies").iterdir() if "staged" in p.name]
    rotten = source.keys(windows).where("window_id = 1").selectExpr("key", "unhex('00') as body", "'no' as sha256")
    rotten.write.parquet(f"{store.path}/batch=rotten")
    assert source.read(windows).where("window_id = 1").count() > 0
    assert store.corrupt(spark).count() == 1 and store.sound(spark).count() == 6 and store.entries(spark).count() == 7
    assert source.read(windows.unionByName(windows)).count() == 2 * source.read(windows).count()  # a window asked for twice is one request
    assert store.entries(spark).count() == 7


def test_http_on_this_machine(spark):
    answers, lock = FormulaTransport(), threading.Lock()

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            from urllib.parse import parse_qsl, urlsplit

            u = urlsplit(self.path)
            params = dict(parse_qsl(u.query)) or None
            try:
                with lock:
                    reply = answers.get(u.path, params, 1.0)
            except TimeoutError:
                reply = Reply(503, "", b"")
            body = reply.body.replace(b"http://made.up", f"http://127.0.0.1:{self.server.server_port}".encode()) if "json" in reply.content_type else reply.body
            self.send_response(reply.status)
            self.send_header("Content-Type", reply.content_type)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://127.0.0.1:{server.server_port}"
        http_client = Client(HttpTransport(), retries=2, timeout_s=10.0, backoff_s=0.0)
        assert read_service(spark, height_service(http_client, url, GRID), (0, 0, 6, 6), 3).count() == sum((c + r) % 7 > 0 for c in range(6) for r in range(6))
        rgba = read_service(spark, imagery_service(http_client, url, 1 / 1024), (100, 50, 6, 4), 4).where("col = 103 and row = 52").first()
        assert tuple(rgba) == (103, 52, 103, 156, 128, 0)
    finally:
        server.shutdown()


def test_a_task_holds_few_replies(spark, tmp_path, monkeypatch):
    """Neither requests that were answered, nor replies and heights of a whole batch."""
    transport = FormulaTransport()
    service = height_service(Client(transport, retries=2, backoff_s=0.0), "http://made.up/heights", GRID)
    for k in range(50):
        service.body(k, k, 4, 3)
    assert not transport.tried
    made = []
    assert [x for x in services._parts(iter(range(1, 8)), lambda x: made.append(x) or x, 6)] == [[1, 2, 3], [4, 5], [6], [7]] and made == list(range(1, 8))
    monkeypatch.setattr(services, "HELD_BYTES", 100)
    windows = spark.range(300).select(F.col("id").alias("window_id"), F.col("id").alias("col_min"), (F.col("id") * 2).alias("row_min"), F.lit(4).alias("width"), F.lit(3).alias("height"))
    got = ServiceSource(service, ReplyStore(f"{tmp_path}/replies")).read(windows).collect()
    want = {(i, c, r): 0.25 * c - 0.125 * r + 100 for i in range(300) for c in range(i, i + 4) for r in range(2 * i, 2 * i + 3) if (c + r) % 7}
    assert {(g["window_id"], g["col"], g["row"]): g["v"] for g in got} == want and len(got) == len(want)
