import hashlib
import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from lindero.functions import documents
from lindero.operators import contracts, views
from lindero.sources import provider_pages as pages
from lindero.sources import stores, transfer
from lindero.sources.transfer import FetchError, Response

NOW = datetime(2026, 8, 1, tzinfo=timezone.utc)


def server(*answers):
    """A transport that gives these answers in turn and keeps the addresses."""
    left, seen = list(answers), []

    def get(url, seconds, most):
        seen.append(url)
        got = left.pop(0)
        if isinstance(got, Exception):
            raise got
        return got

    return get, seen


def test_retry_after():
    assert transfer.retry_after("7") == 7 and transfer.retry_after("900") == 60 and transfer.retry_after("-1") is None and transfer.retry_after(None) is None and transfer.retry_after("soon") is None
    assert transfer.retry_after("Sat, 01 Aug 2026 00:00:20 GMT", NOW) == 20 and transfer.retry_after("Fri, 31 Jul 2026 00:00:00 GMT", NOW) == 0


def test_download_retries_and_redirects():
    slept = []
    get, seen = server(Response(503), Response(429, headers={"retry-after": "9"}), OSError("reset"), Response(301, headers={"location": "/b"}), Response(200, b"ok"))
    got, at, attempts = transfer.download("https://a.org/a", get, sleep=slept.append)
    assert (got.body, at, attempts, slept) == (b"ok", "https://a.org/b", 4, [0.25, 9.0, 1.0]) and seen[-1] == "https://a.org/b"
    for answers, code in (
        ([Response(404)], "HTTP_404"), ([Response(302, headers={"location": "http://a.org"})], "UNTRUSTED_URL"), ([Response(302)], "INVALID_REDIRECT"), ([Response(302, headers={"location": "/x"})] * 6, "REDIRECT_LIMIT"),
        ([Response(200, b"x" * 11)], "BYTE_LIMIT"), ([Response(200, headers={"content-length": "11"})], "BYTE_LIMIT"), ([Response(500)] * 4, "HTTP_500"),
    ):
        with pytest.raises(FetchError, match=code):
            transfer.download("https://a.org/a", server(*answers)[0], sleep=lambda s: None, most=10)
    for url in ("http://a.org", "https://me@a.org", "ftp://a.org", "https://", "https://a.org:x"):
        with pytest.raises(FetchError):
            transfer.trusted(url)
    waits = []
    assert transfer.fetch_text("https://a.org", server(Response(500), Response(500), Response(200, b"t"))[0], 2, 0.35, True, waits.append) == "t" and waits == [0.35, 0.7]


def test_xml_index():
    hosts = ("a.org",)
    ok = Response(200, "﻿<rss>ñ</rss>".encode(), {"content-type": "Text/XML; charset=utf-8"})
    got = transfer.fetch_xml("https://a.org/r", hosts, server(Response(301, headers={"location": "https://A.org:443/s"}), ok)[0], True)
    assert got["xml"] == "<rss>ñ</rss>" and got["final_url"] == "https://A.org:443/s" and got["sha256"] == hashlib.sha256(ok.body).hexdigest()
    for answer, code in ((Response(200, b"", {"content-type": "text/html"}), "CONTENT_TYPE"), (Response(200, b"\xff"), "ENCODING"), (Response(500), "HTTP_STATUS"), (Response(301, headers={"location": "https://b.org"}), "UNTRUSTED_URL"), (Response(301, headers={"location": "https://a.org:8443"}), "UNTRUSTED_URL")):
        with pytest.raises(FetchError, match=code):
            transfer.fetch_xml("https://a.org/r", hosts, server(answer)[0], True)
    with pytest.raises(FetchError, match="SOURCE_NOT_AUTHORIZED"):
        transfer.fetch_xml("https://a.org/r", hosts, server()[0], False)


def test_pacer():
    now, slept = [0.0], []
    pace = transfer.Pacer(2.0, lambda: now[0], slept.append)
    for url, at in (("https://a.org/1", 0.0), ("https://b.org/1", 0.5), ("https://a.org/2", 0.5), ("https://a.org/3", 9.0)):
        now[0] = at
        pace(url)
    assert slept == [1.5]


def test_fetch_table(spark):
    def transport(url, seconds, most):
        return Response(200, url.encode()) if "good" in url else Response(404)

    rows = spark.createDataFrame([("https://good.org/1",), ("https://bad.org/1",), ("http://good.org/2",), (None,)], "u string").where("u IS NOT NULL")
    got = {r.url: (r.body and bytes(r.body), r.error) for r in transfer.fetch_table(rows, "u", transport, 0.0).collect()}
    assert got == {"https://good.org/1": (b"https://good.org/1", None), "https://bad.org/1": (None, "HTTP_404"), "http://good.org/2": (None, "UNTRUSTED_URL")}


ROSTER = """<body><table><tr><td>otra</td></tr></table><table><tr><th>Médico&nbsp;/ Técnico<th>Especialidad<th>Lun.<tr><td>Ana<br>Paz<td>Cardiología<td>8 a 9</tr><tr><td><td> <td></tr></table>
<table><tr><td>Medico</td><td>Especialidad</td></tr><tr><td>No</td><td>No</td></tr></table></body>"""


def test_schedule_table_and_options():
    assert pages.schedule_table(ROSTER) == (["Médico / Técnico", "Especialidad", "Lun."], [["Ana | Paz", "Cardiología", "8 a 9"]])
    assert pages.schedule_table("<p>No se  encontraron <b>Resultados</b></p>") == ([], [])
    with pytest.raises(ValueError):
        pages.schedule_table("<table><tr><td>x</td></tr></table>")
    html = '<select name="FiltroId2"><option value="9">no</select><select id="FiltroId2"><option value="0">Todos<option value=" 7 ">Eva  Luz<option value="7">again<option value="8"></select>'
    assert pages.doctor_options(html) == [("7", "Eva Luz")] and pages.doctor_options(html.replace('id="FiltroId2"', "")) == [("9", "no")]
    with pytest.raises(ValueError):
        pages.doctor_options("<select id='FiltroId2'></select>")


def test_directory_and_center_pages():
    html = """<table id="t"><thead><tr><td class="column-1">Esp</td></tr></thead><tbody><tr><td class="column-1">Cardio</td><td class="x column-2">Ana</td><td class="column-3"><a href="/c">Centro</a></td><td class="column-4">Calle</td></tr>
    <tr><td class="column-1"></td><td class="column-2">Eva</td></tr></tbody></table>"""
    got = pages.directory_rows(html, "t")
    assert [(r["row"], r["specialty"], r["physician"], r["href"], r["complete"]) for r in got] == [(1, "Cardio", "Ana", "/c", True), (2, "", "Eva", "", False)] and pages.directory_rows(html, "u") == []
    head = "<tr><td>Técnico</td><td>Días y horarios</td></tr>"
    html = f"""<h2>Pediatría</h2><div><table>{head}<tr><td>Dra. Ana (nota) x<br>Ref</td><td>Lunes<br>8 a 9</td></tr><tr><td>solo</td></tr></table></div>
    <dl><dt class="sc-accordion-title">Cardio</dt><dd class="sc-accordion-pane"><table>{head}<tr><td>Eva</td><td>9</td></tr></table></dd></dl><table><caption>Propio</caption>{head}<tr><td>Iva</td><td></td></tr></table><table><tr><td>otra</td></tr></table>"""
    got = pages.center_rows(html)
    assert [(r["specialty"], r["physician"], r["schedule"], r["valid"]) for r in got] == [("Pediatría", "Dra. Ana", "Lunes\n8 a 9", True), ("Pediatría", "solo", "", False), ("Cardio", "Eva", "9", True), ("Propio", "Iva", "", False)]
    assert got[0]["label"] == "Dra. Ana (nota) x\nRef"


def test_accordion(spark):
    who = '<div class="horarios-medico"><div class="d-none d-lg-block"><span class="fw-medium text-primary">Ana Paz</span></div><div class="horarios-clinica-mobile">Clínica <span>icono</span></div><div class="horarios-mobile">{}</div></div>'
    entry = '<div class="d-lg-none"><span class="fw-medium">Lunes:</span> 8:00 a 9:30</div>'
    html = '<div class="accordion-item horarios-v2-grid-especialidad"><div class="horarios-v2-grid-especialidad-header"><b class="fw-semibold">Cardio</b></div>' + who.format(entry + '<div class="d-lg-none">sin día</div>') + who.format("") + "</div>"
    got = pages.accordion_rows(json.dumps({"resultados_html": html}))
    assert [(r["specialty"], r["physician"], r["clinic"], r["day"], r["schedule"], r["valid"], r["physician_row"]) for r in got] == [
        ("Cardio", "Ana Paz", "Clínica", "Lunes", "Lunes: 8:00 a 9:30", True, 1), ("Cardio", "Ana Paz", "Clínica", "", "", False, 1), ("Cardio", "Ana Paz", "Clínica", "", "", False, 2),
    ]
    table = spark.createDataFrame([(1, json.dumps({"resultados_html": html})), (2, "{}"), (3, None)], "id int, body string")
    out = pages.exploded(table, "id", "body", pages.accordion_rows, "specialty string, physician string, schedule string, valid boolean")
    assert sorted((r.id, r.valid, r.error is not None) for r in out.collect() if r.id != 1) == [(2, None, True), (3, None, True)] and out.where("id = 1 AND valid").count() == 1


def test_seed_and_files(spark, tmp_path):
    store = {"t": spark.createDataFrame([(1, "old")], "id int, v string")}
    rows = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a"), (None, "n"), (None, "n")], "id int, v string")

    def append(name, df):
        store[name] = spark.createDataFrame(store[name].union(df).collect(), "id int, v string")

    assert stores.seed({"t": (rows, ["id"])}, store.__getitem__, append) == {"t": 3}
    assert sorted(map(tuple, store["t"].where("id IS NOT NULL").collect())) == [(1, "old"), (2, "a")]
    assert stores.seed({"t": (rows.where("id IS NOT NULL"), ["id"])}, store.__getitem__, append) == {"t": 0}
    for name, body in (("x/2024/a.ndjson", "1"), ("x/2025/a.ndjson", "22"), ("x/2025/b.txt", "3")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(body)
    files = stores.found_files(spark, str(tmp_path / "x"), "*.ndjson")
    assert files.count() == 2 and stores.last_path(files).first().path.endswith("2025/a.ndjson") and stores.newest(files).count() == 1
    assert stores.newest(files.limit(0)).count() == 0
    assert stores.jdbc_options("jdbc:postgresql://h/d", "t", "id", (1, 9), 4)["numPartitions"] == "4"
    for bad in ({"url": "http://h", "table": "t"}, {"url": "jdbc:x", "table": "t", "column": "id"}):
        with pytest.raises(ValueError):
            stores.jdbc_options(**bad)


def test_progress(tmp_path):
    target = tmp_path / "out.ndjson"
    batches = [[{"record_id": "a", "v": "ñ"}], [{"record_id": "a"}, {"record_id": "b"}]]
    assert stores.append_with_progress(target, batches, 1) == {"requests": 2, "written": 2, "duplicates": 1, "state": "COMPLETE"}
    assert stores.append_with_progress(target, batches)["written"] == 2 and len(target.read_text().splitlines()) == 2
    assert json.loads((tmp_path / "out.ndjson.progress.json").read_text())["state"] == "COMPLETE"


def test_canonical_json_and_seal():
    value = {"b": [1, 2.0, 0.5, None, True], "a": {"ñ": "\"x\"", "\U0001f600": 1, "￿": 2}}
    assert documents.canonical_json(value) == '{"a":{"ñ":"\\"x\\"","\U0001f600":1,"￿":2},"b":[1,2,0.5,null,true]}'
    key = b"k" * 32
    sealed = documents.sealed({"x": 1}, key, "key-1")
    assert documents.is_sealed(sealed, key, "key-1") and not documents.is_sealed(sealed | {"x": 2}, key, "key-1") and not documents.is_sealed(sealed, b"l" * 32, "key-1") and not documents.is_sealed({"x": 1}, key, "key-1")
    for bad in (float("nan"), object()):
        with pytest.raises(ValueError):
            documents.canonical_json(bad)
    with pytest.raises(ValueError):
        documents.sealed({}, key, "no spaces")


def policy():
    d = {"approved": True, "reference": "r", "reviewedAt": "2026-07-01T00:00:00.000Z", "reviewedBy": "me"}
    source = {
        "allowedFieldPaths": list(documents.ALLOWED), "attribution": "a", "canonicalUrl": "https://a.org/", "dataset": "d", "key": "k", "legalBasis": d, "liveLookupUrl": "https://a.org/l", "maxSourceAgeDays": 60, "publisher": "p",
        "purposeCompatibility": d, "reuseAuthorization": d | {"basis": "OPEN_DATA_LICENSE"}, "validUntil": "2027-01-01T00:00:00.000Z",
    }
    return {
        "schemaVersion": 1, "policyId": "p1", "policyExpiresAt": "2027-01-01T00:00:00.000Z", "approvedSnapshot": {"profilesSha256": "0" * 64, "snapshotId": "factual-v3-" + "a" * 16}, "source": source,
        "releasePrerequisites": {k: d for k in documents.PREREQUISITES},
    }


def test_policy():
    write = lambda p: (json.dumps(p, ensure_ascii=False, indent=2) + "\n").encode()
    assert documents.parse_policy(write(policy()), "k", NOW)["policyId"] == "p1"
    with pytest.raises(ValueError, match="canonical"):
        documents.parse_policy(json.dumps(policy()).encode(), "k", NOW)
    for path, value in (
        (("extra",), 1), (("schemaVersion",), 2), (("policyExpiresAt",), "2026-08-01T00:00:00.000Z"), (("source", "key"), "other"), (("source", "canonicalUrl"), "http://a.org"), (("source", "maxSourceAgeDays"), 0), (("source", "allowedFieldPaths"), ["id"]),
        (("source", "legalBasis", "approved"), False), (("source", "legalBasis", "reviewedAt"), "2026-09-01T00:00:00.000Z"), (("source", "reuseAuthorization", "basis"), "PENDING"), (("approvedSnapshot", "snapshotId"), "x"), (("releasePrerequisites", "controllerNotice"), {}),
    ):
        p = json.loads(json.dumps(policy()))
        at = p
        for k in path[:-1]:
            at = at[k]
        at[path[-1]] = value
        with pytest.raises(ValueError):
            documents.parse_policy(write(p), "k", NOW)


def test_settings():
    assert documents.flag(" TRUE ") and not documents.flag(None) and documents.flag("", True) and documents.bounded(" 7 ", 1, 0, 9) == 7 and documents.bounded(None, 1, 0, 9) == 1
    for bad in ("maybe",):
        with pytest.raises(ValueError):
            documents.flag(bad)
    for bad in ("10", "1.5", "x"):
        with pytest.raises(ValueError):
            documents.bounded(bad, 1, 0, 9)


def test_gates(spark):
    outcomes = spark.createDataFrame([("b", "ENABLED"), ("a", "ENABLED"), ("c", "OMITTED")], "id string, outcome string")
    assert contracts.rights_gate(outcomes) == (["a", "b"], ["c"])
    for bad in ([("a", "OMITTED")], [("a", "ENABLED"), ("b", "REVIEW_EXPIRED")]):
        with pytest.raises(ValueError):
            contracts.rights_gate(spark.createDataFrame(bad, "id string, outcome string"))
    rows = spark.createDataFrame([(1, []), (2, ["X"])], "id int, violations array<string>")
    assert contracts.require_clean(rows.where("id = 1")).count() == 1
    with pytest.raises(Exception, match="violations: X"):
        contracts.require_clean(rows).collect()
    with pytest.raises(Exception, match="unknown temporary registration"):
        spark.createDataFrame([("other",)], "v string").select(contracts.temporary_registration(F.col("v"))).collect()
    assert views.grants(["v"], [("v", "SELECT"), ("t", "SELECT"), ("v", "INSERT")]) == [("t", "SELECT"), ("v", "INSERT")]


def test_stages_tell_their_status(tmp_path):
    from lindero.sources import artifacts

    note, seen = tmp_path / "status.json", []
    got = artifacts.run_stages([("a", lambda: seen.append(json.loads(note.read_text()))), ("b", lambda: 1 / 0), ("c", lambda: None)], note)
    assert seen[0]["state"] == "RUNNING" and [s["state"] for s in got] == ["SUCCEEDED", "FAILED", "PENDING"] and json.loads(note.read_text())["state"] == "FAILED"
    artifacts.run_stages([("a", lambda: None)], note)
    assert json.loads(note.read_text()) == {"schemaVersion": 1, "state": "SUCCEEDED", "stages": [{"stage": "a", "state": "SUCCEEDED"}]}


def test_purge(tmp_path):
    from lindero.sources import artifacts

    for name, end in (("old", "2026-01-01"), ("now", "2026-08-01"), ("new", "2027-01-01")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "manifest.json").write_text(json.dumps({"expiresAt": end}))
    assert [p.name for p in artifacts.purge([tmp_path], "2026-08-01")] == ["now", "old"] and (tmp_path / "old").exists()
    artifacts.purge([tmp_path], "2026-08-01", apply=True)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["new"]


def test_blank_required_field(spark, tmp_path):
    from lindero.sources import readers

    (tmp_path / "a.csv").write_text("id,name\n1,A\n2, \n")
    assert readers.read_delimited_strict(spark, str(tmp_path / "a.csv"), ["id", "name"], required=("id",)).count() == 2
    with pytest.raises(Exception, match="row 3 has an empty name"):
        readers.read_delimited_strict(spark, str(tmp_path / "a.csv"), ["id", "name"], required=("name",)).collect()


def test_streams(spark, tmp_path):
    from lindero.streaming import feeds

    rows = spark.createDataFrame([(i, i % 3, f"2024-01-01 0{i % 4}:30:00") for i in range(40)], "id int, k int, t string").withColumn("t", F.to_timestamp("t"))
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    read = lambda: spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        feeds.write_once(read(), str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(40))
    counts = feeds.window_counts(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), "t", "k", "1 hour", "1 hour")
    q = counts.writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = {(str(r.w.start), r.k): r.n for r in rows.groupBy(F.window("t", "1 hour").alias("w"), "k").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {(str(r.w.start), r.k): r.n for r in spark.table("windows").collect()} == want
    kept = feeds.with_expiry(rows, "t").select("t", "expires_at").first()
    assert (kept.expires_at - kept.t).days == 90
