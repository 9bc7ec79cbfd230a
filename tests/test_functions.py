import hashlib
import hmac
import unicodedata

import pytest
from pyspark.sql import functions as F

from lindero.functions import ids, names, text
from lindero.operators import linkage, news, publication, registry, search
from lindero.sources import artifacts, readers

NAMES = [("Dra. María Pérez Gómez", "MARIA PEREZ GOMEZ"), ("PÉREZ GÓMEZ, MARÍA", "MARIA PEREZ GOMEZ"), ("Dr.  Juan José Núñez", "JUAN JOSE NUNEZ"), ("Lic. Ana Silva (videoconsulta)", "ANA SILVA"), ("Téc. Lucía Ramos", "LUCIA RAMOS"), ("Q.F. Álvaro Méndez", "ALVARO MENDEZ"), ("Pérez, Ana, María", "PEREZ ANA MARIA"), ("Pérez, Dra. Ana", "DRA ANA PEREZ")]


def one(spark, column, **values):
    kinds = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'array<string>'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], kinds).select(column).first()[0]


def test_person_names(spark):
    got = spark.createDataFrame(NAMES, "a string, b string").select(text.person_name(F.col("a"))).collect()
    assert [r[0] for r in got] == [b for _, b in NAMES]


def test_fold_is_nfkd_without_marks(spark):
    for x in ("Ñandú Žluťoučký", "ＡＢＣ", "é", "Ελλάς ά"):
        want = "".join(c for c in unicodedata.normalize("NFKD", x) if unicodedata.category(c)[0] != "M")
        assert one(spark, text.fold(F.col("a")), a=x) == want
        assert one(spark, text.fold_exact(F.col("a")), a=x) == want


def test_keys(spark):
    assert one(spark, text.match_key(F.col("a")), a=" Niño  ÁB-1 ") == "nino ab 1"
    assert one(spark, text.physician_key(F.col("a")), a="Dra. Ana Paz (lunes) tarde") == "ana paz"
    assert one(spark, text.cell_text(F.col("a")), a=" a  b\n\n c ") == "a b | c"
    assert one(spark, text.token_multiset(F.col("a")), a="B A B") == "A B B"
    assert one(spark, text.like_escape(F.col("a")), a="5%_\\") == "5\\%\\_\\\\"
    assert one(spark, text.specialty_consistent(F.col("a"), F.lit("MEDICO EN CARDIOLOGIA")), a="Cardiología") is True
    assert one(spark, text.specialty_consistent(F.col("a"), F.lit("DOCTOR EN MEDICINA")), a="Medicina") is False
    assert one(spark, text.medical_context(F.col("a")), a="La dra. Paz") is True
    assert [tuple(x) for x in one(spark, text.intervals(F.col("a")), a="de 8:00 a 12:30 y 25:00 a 26:00")] == [("08:00", "12:30")]
    assert one(spark, text.mask_names(F.col("a"), F.col("n")), a="ana paz y ana", n=["ana", "ana paz"]) == "professional y professional"
    assert one(spark, text.mask_names(F.col("a"), F.col("n")), a="ana paz ana paz habla anabel", n=["ana paz", "ana"]) == "professional professional habla anabel"
    assert one(spark, text.medical_context(F.col("a")), a="Dra. Paz inaugura") is False and one(spark, text.medical_context(F.col("a")), a="Paz (hospital) inaugura") is False
    assert one(spark, text.identity_name(F.col("a")), a=" nº  5 ½ Ñu ") == "Nº 5 ½ NU" and one(spark, text.match_key(F.col("a")), a="nº 5 1ª ﬁn") == "n 5 1 n"
    assert one(spark, text.credential(F.col("a")), a="ﬁn ﬂor ½") == "FIN FLOR 1 2" and one(spark, text.policy_key(F.col("a")), a="ﬁn Ⅷ") == "fin viii"


@pytest.mark.parametrize(
    "canonical, observed, kind",
    [
        ("MARIA ANA PEREZ GOMEZ", "MARIA ANA PEREZ GOMEZ", names.EXACT), ("MARIA ANA PEREZ GOMEZ", "ANA GOMEZ", names.PARTIAL), ("ANA GOMEZ", "MARIA ANA PEREZ GOMEZ", names.PARTIAL), ("MARIA ANA PEREZ", "M PEREZ", names.INITIALS),
        ("MARIA PEREZ", "M P", None), ("MARIA PEREZ", "P MARIA", None), ("MARIA PEREZ", "MARIA", None), ("", "A B", None), ("MARIA PEREZ", "MARIA GOMEZ", None), ("MARIA MARIA PEREZ", "MARIA PEREZ", None),
    ],
)
def test_flexible_names(spark, canonical, observed, kind):
    got = one(spark, names.flexible_match("c", "o"), c=canonical, o=observed)
    assert (got and got["kind"]) == kind


def test_ids(spark):
    key = b"k" * 40
    assert one(spark, ids.hmac_sha256(key, F.col("a")), a="é1") == hmac.new(key, "é1".encode(), hashlib.sha256).hexdigest()
    with pytest.raises(ValueError):
        ids.pads(b"short")
    u = one(spark, ids.uuid_v8(F.col("a")), a="0123456789abcdef0123456789abcdef")
    assert u == "01234567-89ab-8def-8123-456789abcdef"
    assert one(spark, ids.slug(F.col("a")), a=" ¡Ñandú & Cía! ") == "nandu-cia" and one(spark, ids.slug(F.col("a")), a="¡!") == "profesional"
    assert one(spark, ids.canonical_url(F.col("a")), a="http://a.org:443/x?q=1#t") == "https://a.org/x?q=1" and one(spark, ids.canonical_url(F.col("a")), a="ftp://a") is None
    cursor = ids.encode_cursor("ana", "01234567-89ab-8def-8123-456789abcdef")
    assert ids.decode_cursor(cursor)[0] == "ana"
    for bad in ("", "x", cursor[:-3]):
        with pytest.raises(ValueError):
            ids.decode_cursor(bad)


def test_review_points(spark):
    def points(kind, coverage, ambiguous, medical, corroborated):
        c = [F.lit(x) for x in (kind, coverage, ambiguous, medical, corroborated)]
        return spark.range(1).select(news.review_points(*c)).first()[0]

    assert points(names.PARTIAL, 0.5, False, False, False) == 20
    assert points(names.INITIALS, 0.0, False, False, True) == 25
    assert points(names.EXACT, 1.0, False, True, False) == 49
    assert points(names.INITIALS, 0.0, True, False, False) == 1


def test_headline_classes(spark):
    assert one(spark, news.sensitive_classes(F.col("a")), a="condenan por mala praxis a un menor") == ["ADVERSE_OR_JUDICIAL", "MINOR"]
    assert one(spark, news.sensitive_classes(F.col("a")), a="premio nacional") == []


def test_registry_and_linkage(spark):
    rows = spark.createDataFrame([(1, "Ana", "T", "X"), (1, "ANA", "U", None), (2, "Eva", "T", "X"), (2, "Iva", "T", "X")], "doc int, name string, title string, code string")
    got = {r.doc: (r.names, r.quarantined) for r in registry.identities(rows, "doc", "name", F.upper("name")).collect()}
    assert got == {1: (["ANA"], False), 2: (["Eva", "Iva"], True)}
    assert registry.qualifying(rows, "doc", F.col("title") == "U").count() == 2
    with pytest.raises(ValueError):
        registry.gate(2, 3)
    people = spark.createDataFrame([(1, "A B", "T"), (2, "C D", "T"), (3, "C D", "V")], "id int, name_key string, title string")
    seen = spark.createDataFrame([("i", "B A", "A B", "T"), ("i", "D C", "C D", "T"), ("i", "E F", "E F", "T")], "institution string, normalized_name string, name_key string, specialty string")
    got = {r.normalized_name: r.status for r in linkage.link(linkage.group_observations(seen), people).collect()}
    assert got == {"B A": "exact_name_and_title_consistent", "D C": "ambiguous_exact_name", "E F": "unmatched"}


def test_keyset_pages_tile(spark):
    import uuid

    people = spark.createDataFrame([(f"n{i // 3}", str(uuid.UUID(int=i))) for i in range(20)], "name string, public_id string")
    seen, cursor = [], None
    while True:
        page, cursor = search.search(people, "name", "public_id", 7, None, cursor)
        seen += [tuple(r) for r in page]
        if cursor is None:
            break
    assert seen == sorted(tuple(r) for r in people.collect())
    for limit in (0, 51, True):
        with pytest.raises(ValueError):
            search.check_bounds(limit)


def test_allowlist(spark):
    df = spark.range(1).select(F.struct(F.lit(1).alias("x"), F.array(F.struct(F.lit("a").alias("y"))).alias("z")).alias("s"), F.lit(1).alias("t"))
    assert publication.leaf_paths(df.schema) == ["s.x", "s.z[].y", "t"]
    with pytest.raises(ValueError):
        publication.project_allowed(df, ["s.x"])


def test_strict_delimited():
    assert readers.parse_delimited('﻿a,b\r\n"x ""q"" ,\r\ny",\r\n\r\nz,w') == [["a", "b"], ['x "q" ,\ny', ""], [""], ["z", "w"]]
    assert readers.parse_delimited("a\n") == [["a"]]
    for bad in ('a"b', '"a"x', '"a'):
        with pytest.raises(ValueError):
            readers.parse_delimited(bad)
    assert readers.decode_cp1252(b"\x80\x81\xe1") == "€\x81á"


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("id;name\n1;José\n".encode("cp1252"))
    assert [tuple(r) for r in readers.read_delimited_strict(spark, str(tmp_path / "a.csv"), ["id", "name"], ";", "cp1252").collect()] == [("1", "José", 2)]
    (tmp_path / "f.xml").write_text("<rss><channel><item><title> T </title><link>http://a</link><pubDate>Mon, 01 Jan 2024 10:00:00 GMT</pubDate></item><item><title/><link>x</link></item></channel></rss>")
    items = [("T", "http://a.org/1#x", "Mon, 01 Jan 2024 10:00:00 GMT"), ("", "https://a.org/2", "Mon, 01 Jan 2024 10:00:00 GMT"), ("U", "https://a.org/3", "some day"), ("V", "https://a.org/4", "Mon, 01 Jan 2024 11:00:00 GMT"), (" W ", "https://a.org/1", "Mon, 01 Jan 2024 12:00:00 GMT"), ("x" * 1001, "https://a.org/5", "Mon, 01 Jan 2024 10:00:00 GMT"), ("Y", "ftp://a.org/6", "Mon, 01 Jan 2024 10:00:00 GMT")]
    (tmp_path / "f.xml").write_text("<rss><channel>" + "".join(f"<item><title>{t}</title><link>{u}</link><pubDate>{d}</pubDate></item>" for t, u, d in items) + "</channel></rss>")
    valid, invalid = readers.feed_items(readers.read_feed(spark, str(tmp_path / "f.xml")), ["a.org"])
    got = [(r.title, r.url, str(r.published_at)) for r in valid.orderBy("place").collect()]
    assert got == [("W", "https://a.org/1", "2024-01-01 12:00:00"), ("V", "https://a.org/4", "2024-01-01 11:00:00")] and [r.invalid for r in invalid.collect()] == [4]
    lines = spark.createDataFrame([('{"name": "a"}',), ("[1]",), ("{",), ('{"name": " "}',), ("",)], "value string")
    good, bad = readers.ndjson_with_quarantine(lines, "name string", "name")
    assert good.count() == 1 and sorted(r.reason for r in bad.collect()) == ["invalid_json", "missing_name", "not_an_object"]
    html = "<table><tr><th>Médico</th><th>Especialidad</th></tr><tr><td>Ana<br>Paz</td><td>X</td></tr></table><select><option value=0>-</option><option value=7>Eva</option></select>"
    assert readers.html_options(html) == [("7", "Eva")]
    rows = readers.explode_tables(spark.createDataFrame([(1, html), (2, None)], "id int, html string"), "html", "id")
    assert [tuple(r) for r in readers.by_header(rows, "id", {"name": ["medico"], "specialty": ["especialidad"]}).collect()] == [(1, 0, 1, "Ana | Paz", "X")]


def test_artifacts(spark, tmp_path):
    data = "".join(r.value + "\n" for r in artifacts.to_ndjson(spark.createDataFrame([(2, None), (1, "ñ")], "a int, b string"), ["a"]).collect()).encode()
    assert data == '{"a":1,"b":"ñ"}\n{"a":2,"b":null}\n'.encode()
    artifacts.install(tmp_path / "x", {"d.ndjson": data})
    artifacts.install(tmp_path / "x", {"d.ndjson": data})
    with pytest.raises(FileExistsError):
        artifacts.install(tmp_path / "x", {"d.ndjson": b"other"})
    assert artifacts.verify(tmp_path / "x") == []
    (tmp_path / "x/d.ndjson").write_bytes(b"changed")
    assert artifacts.verify(tmp_path / "x") == ["d.ndjson"]
    with pytest.raises(ValueError):
        artifacts.inside(tmp_path / "x", tmp_path)
    got = artifacts.run_stages([("a", lambda: None), ("b", lambda: 1 / 0), ("c", lambda: None)])
    assert [s["state"] for s in got] == ["SUCCEEDED", "FAILED", "PENDING"]


def test_stream_equals_batch(spark, tmp_path):
    from lindero.streaming import feeds

    rows = spark.createDataFrame([(i % 5, f"2024-01-01 0{i % 3}:00:00") for i in range(30)], "k int, t string").withColumn("t", F.to_timestamp("t"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = feeds.deduplicate(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), ["k"], "t")
    q = stream.writeStream.format("memory").queryName("dedup").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r.k for r in spark.table("dedup").collect()) == [0, 1, 2, 3, 4]


def context_brute(context, observed):
    def alike(x, y):
        return x == y or any(x.startswith(s) and y.startswith(s) for s in news.SPECIALTY_STEMS) or (len(x) >= 6 and len(y) >= 6 and x[:6] == y[:6])

    return sum(any(alike(x, y) for y in observed) for x in set(context) if len(x) >= 3 and x not in news.GENERIC_CONTEXT)


def test_context_match(spark):
    contexts = ["CIRUGIA GENERAL", "HOSPITAL DE LA PAZ", "UROLOGIA", "CLINICO", "EN EL Y", "CARDIOLOGIA INFANTIL PAZ SOL", "HOSPITAL", ""]
    observed = ["EL CIRUJANO", "PAZ", "HOSPITAL GENERAL", "CLINICA", "UROLOGO DE SOL A SOL", "CARDIOLOGO INFANTE", "LA EN Y", ""]
    a = spark.createDataFrame([(i, x.split(" ")) for i, x in enumerate(observed)], "d long, words array<string>")
    b = spark.createDataFrame([(i, x.split(" ")) for i, x in enumerate(contexts)], "i long, words array<string>")
    want = {(d, i): n for d, x in enumerate(observed) for i, y in enumerate(contexts) if (n := context_brute(y.split(" "), x.split(" ")))}
    assert {(r.d, r.i): r.shared for r in news.context_pairs(a, b, "d", "i").collect()} == want and want[0, 0] == 1 and (2, 6) not in want
    crossed = a.crossJoin(b.withColumnRenamed("words", "meant")).where(news.context_match(F.col("meant"), F.col("words")))
    assert {(r.d, r.i) for r in crossed.collect()} == set(want)


def test_context_match_query(spark):
    from lindero.plans import catalog

    from .conftest import DATA

    key = lambda t: text.credential(F.col(t)).alias("k")
    docs, items = ({r[0]: r.k.split(" ") for r in spark.read.parquet(f"{DATA}/{n}.parquet").select(c, key("text")).collect()} for n, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    got = {(r.doc_id, r.item_id): r.shared for r in catalog.QUERIES["context_match"](spark, DATA).collect()}
    some = sorted(docs, key=lambda d: len(docs[d]))[:40]
    want = {(d, i): n for d in some for i in items if (n := context_brute(items[i], set(docs[d])))}
    assert {k: v for k, v in got.items() if k[0] in set(some)} == want and want


def test_names_link_across_brands(spark):
    from lindero.plans import catalog

    from .conftest import DATA

    part = spark.read.parquet(f"{DATA}/part.parquet").collect()
    want = {r.p_partkey: "|".join(map(str, sorted(x.p_partkey for x in part if x.p_name == r.p_name and x.p_partkey != r.p_partkey))) for r in part}
    assert {r.p_partkey: r.competing for r in catalog.QUERIES["competing_ids"](spark, DATA).collect()} == want
    pairs = [(a.p_partkey, b.p_partkey, a.p_name == b.p_name) for a in part for b in part if a.p_partkey < b.p_partkey and sorted(a.p_name.split(" ")) == sorted(b.p_name.split(" "))]
    assert sorted((r.part_a, r.part_b, r.ordered) for r in catalog.QUERIES["linkage_evidence"](spark, DATA).collect()) == sorted(pairs)
    brand = {r.p_partkey: r.p_brand for r in part}
    assert any(brand[a] != brand[b] for a, b, _ in pairs)


def test_blocking_loses_no_single_letters(spark):
    words = ["X PEREZ", "A B", "ANA PEREZ", "X Y PEREZ"], ["X P", "A B", "A PEREZ", "X PEREZ", "B A"]
    a, b = (spark.createDataFrame([(i, w) for i, w in enumerate(x)], f"{k}id long, {k} string") for k, x in zip(("c", "o"), words))
    found = {(r.c, r.o, r.match.kind) for r in names.flexible_pairs(a, b, "cid", "c", "oid", "o").collect()}
    crossed = a.crossJoin(b).withColumn("match", names.flexible_match("c", "o")).where("match IS NOT NULL")
    assert found == {(r.c, r.o, r.match.kind) for r in crossed.collect()}
    assert ("X PEREZ", "X P", names.INITIALS) in found and ("A B", "A B", names.EXACT) in found


def test_blocking_loses_no_relation(spark):
    import random

    rng = random.Random(7)
    name = lambda: " ".join(rng.choice(["ANA", "ADA", "PAZ", "SOL", "A", "P", "S", "PAULA", "ROCA", "R"]) for _ in range(rng.randint(1, 5)))
    a, b = (spark.createDataFrame([(i, name()) for i in range(150)], f"{k}id long, {k} string") for k in "co")
    found = {(r.cid, r.oid, r.match.kind) for r in names.flexible_pairs(a, b, "cid", "c", "oid", "o").collect()}
    crossed = a.crossJoin(b).withColumn("match", names.flexible_match("c", "o")).where("match IS NOT NULL")
    assert found == {(r.cid, r.oid, r.match.kind) for r in crossed.collect()} and len({k for _, _, k in found}) == 3
    met = names.blocked_pairs(a.where("c = 'ANA PAZ' OR cid < 0").union(spark.createDataFrame([(900, "ANA PAZ")], "cid long, c string")), spark.createDataFrame([(901, "ANA ROCA")], "oid long, o string"), "cid", "c", "oid", "o")
    assert met.count() == 0  # one common word is no reason to meet
