"""Names, URLs, places, contacts, pages, replies, prompts, plans of the crawl."""

import json
import random

import pytest
from pyspark.sql import functions as F

from leadspark.functions import extract, html, pii, replies, text
from leadspark.operators.grouping import frequent_lookup, in_ranges
from leadspark.operators import crawlplan, discover, enrich, prompts, report
from leadspark.plans import jobs
from leadspark.schemas import COMMERCIAL_STATES, METADATA_FIELDS, VERTICALS, metadata_schema, vertical_dimension


def one(spark, fn, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(fn(*[F.col(f"c{i}") for i in range(len(values))])).first()[0]


CASES = [
    (text.normalize_name, "  El  CANTÓN Ñandú ", "el canton nandu"),
    (text.url_domain, "https://www.example.com/path", "example.com"),
    (text.url_domain, "https://example.com.ar/x", "example.com.ar"),
    (text.url_domain, "not-a-url", ""),
    (text.domain_name_text, "clubnautico.com.ar", "Clubnautico"),
    (text.domain_name_text, "club-nautico.com.ar", "Club Nautico"),
    (text.province_from_address, "Calle 123, Pilar, Córdoba, Argentina", "Córdoba"),
    (text.province_from_address, "Pilar, Argentina", ""),
    (text.canonical_site, "https://X.com", "https://x.com/"),
    (text.canonical_site, "ftp://x.com", None),
    (pii.mask_phone, "(011) 4555-8900", "****-8900"),
    (pii.mask_phone, "12", "****"),
    (pii.redact_text, "tel 011-4567-8901.", "tel ****-8901."),
    (extract.clean_email, " Info@Example.COM ", "info@example.com"),
    (extract.clean_email, "a@b", None),
    (html.node_text, "<p> a &amp; b</p><b>&#241;&#x20AC;&nada;</b>", "a & b ñ€&nada;"),
    (html.html_text, "<nav>x</nav><HEADER class='a'>y</HEADER><p>hola</p><script>if(a<b){}</script><!-- c --> fin", "hola fin"),
    (replies.clean_reply, "<think>x\n{}</think>\n```json\n{\"a\": 1}\n```", '{"a": 1}'),
]


@pytest.mark.parametrize("fn,value,expected", CASES)
def test_functions(spark, fn, value, expected):
    assert one(spark, fn, value) == expected


@pytest.mark.parametrize("value,expected", [
    ("Tigre, Buenos Aires", ("Tigre", "Buenos Aires")), ("Nordelta, Tigre, Buenos Aires", ("Tigre", "Buenos Aires")),
    ("Pilar, GBA", ("Pilar", None)), ("", (None, None)), ("Mendoza · X", ("Mendoza", "Mendoza")),
])
def test_location(spark, value, expected):
    assert tuple(one(spark, text.split_location, value)) == expected


def test_contacts(spark):
    page = "Administración: admin@lagos.example admin@lagos.example ventas@inmo.example intendencia@lagos.example (011) 4555-8900"
    assert len(one(spark, extract.emails_in, page)) == 3
    assert one(spark, extract.phones_in, page) == []
    assert one(spark, extract.phones_in, "+54 11 4555-8900 o 11 4555 8900") == ["+54 11 4555-8900", "11 4555 8900"]


def test_redaction_of_nested_values(spark):
    df = spark.createDataFrame([({"a": "x@y.com"}, [("1", "11 4555 8900")])], "m map<string,string>, l array<struct<k:string,v:string>>")
    row = pii.redact_frame(df).first()
    assert row.m["a"].endswith("@y.com") and "x@" not in row.m["a"] and row.l[0].v == "****-8900"
    assert pii.redact_frame(df, verbose=True).first().m["a"] == "x@y.com"


def test_page_predicates(spark):
    spa = '<html><body><div id="root"></div><script>x</script></body></html>'
    df = spark.createDataFrame([("A" * 400, "", 200), ("short", spa, 200), ("", "", 200), ("A" * 400, "ok", 403)], "t string, h string, s int")
    got = df.select(html.has_content("t"), html.looks_unrendered("h", "t"), html.needs_render("h", "t", "s")).collect()
    assert [tuple(r) for r in got] == [(True, False, True), (False, True, True), (False, True, True), (True, False, True)]


def test_registry_sources(spark):
    table = ("<table><tr><th>Nombre</th><th>Provincia</th></tr><tr><td>Parque Pilar</td><td></td><td><a href='/p/1'>ver</a></td></tr>"
             "<tr><td>ab</td><td>x</td></tr></table>")
    anchors = "<a href='/q'>Parque del Sur</a><a href='x'>otra cosa</a>"
    pages = spark.createDataFrame([(1, table), (2, anchors)], "page_id bigint, html string")
    got = {r.nombre: (r.sitio_web, r.provincia) for r in discover.discovery_source("parques_industriales")(pages).collect()}
    assert got["Parque Pilar"] == ("https://www.caip.org.ar/p/1", "Buenos Aires")
    assert got["Parque del Sur"] == ("https://www.caip.org.ar/q", "Buenos Aires")
    card = '<article><h2>Nordelta</h2><span class="card-location">Tigre, Buenos Aires</span><a href="https://n.example">x</a></article>'
    row = discover.discovery_source("barrios_privados")(spark.createDataFrame([(1, card)], "page_id bigint, html string")).first()
    assert (row.nombre, row.partido, row.provincia, row.raw_data["location_raw"]) == ("Nordelta", "Tigre", "Buenos Aires", "Tigre, Buenos Aires")
    drug = "<table><tr><td>Sur SA</td><td>Pilar</td><td>Córdoba</td><td>Droguería</td></tr><tr><td>DROGUER Norte</td><td>a</td><td>b</td><td>c</td></tr></table>"
    flags = discover.discovery_source("droguerias")(spark.createDataFrame([(1, drug)], "page_id bigint, html string")).collect()
    assert [(r.nombre, r.es_distribuidor) for r in flags] == [("Sur SA", True), ("DROGUER Norte", True)]


def test_search_results(spark):
    urls = ["https://zonaprop.com.ar/result", "https://uces.edu.ar", "https://facebook.com/uni", "https://austral.edu.ar", "https://uces.edu.ar"]
    df = spark.createDataFrame(list(enumerate(urls)), "ord bigint, url string").withColumn("fuente", F.lit("google_dorks"))
    got = discover.search_candidates(df)
    assert [r.sitio_web for r in got.orderBy("ord").collect()] == [urls[1], urls[3], urls[4]]
    assert not one(spark, discover.url_allowed, "https://www.fedex.com/x")


def test_supplement_gate(spark):
    base = spark.createDataFrame([("a",), ("b",)], "sitio_web string")
    extra = spark.createDataFrame([("a",), ("c",), (None,)], "sitio_web string")
    assert discover.supplement(base, extra, 10).count() == 4
    assert discover.supplement(base, extra, 4).count() == 2


def reply(spark, body):
    df = spark.createDataFrame([(body if isinstance(body, str) else json.dumps(body),)], "r string").select(replies.parse_reply("r").alias("v"))
    return df


@pytest.mark.parametrize("body,expected", [
    ({"nombre": "A", "cantidad_habitaciones": 300}, {"cantidad_habitaciones": 300}),
    ({"nombre": "A", "cantidad_habitaciones": "300", "cadena": "x"}, {}),
    ({"nombre": "A", "metadata": {"categoria_estrellas": 5, "tipo": "resort"}}, {"categoria_estrellas": 5, "tipo": "resort"}),
    ({"nombre": "A", "metadata": {"categoria_estrellas": 6}}, {}),
    ({"nombre": "A", "tipo": "hotelito"}, {}),
    ({"nombre": "A", "area_eventos": 1}, {}),
    ({"nombre": "A", "cantidad_habitaciones": 3.5}, {}),
    ("nada", {}),
])
def test_metadata(spark, body, expected):
    assert json.loads(reply(spark, body).select(replies.metadata_json("v", "hoteles")).first()[0]) == expected


def test_metadata_defaults(spark):
    got = reply(spark, {"nombre": "A"}).select(replies.metadata_json("v", "barrios_privados"), replies.metadata_json("v", "clinicas")).first()
    assert json.loads(got[0]) == {"en_base_actual": False}
    assert json.loads(got[1]) == {"especialidades": [], "obras_sociales_principales": []}
    bad = reply(spark, {"especialidades": ["a", 1]}).select(replies.metadata_json("v", "clinicas")).first()
    assert json.loads(bad[0]) == {}


def test_lead_from_reply(spark):
    body = {"nombre": "Parque", "provincia": "Salta", "email": "a@b.com", "sitio_web": "https://x.com", "fuente_contacto": "pie", "email_score": "80"}
    lead = replies.lead_from_reply("v", F.lit("parques_industriales"), F.lit("https://src"), F.current_timestamp(), ["parques_industriales"])
    row = reply(spark, body).select(lead.alias("l")).select("l.*").first()
    assert (row.provincia, row.fuente_contacto, row.sitio_web, row.email_score, row.pais) == ("Salta", "https://src", "https://x.com/", 80, "Argentina")
    assert json.loads(row.metadata)["provincia"] == "Salta"
    for bad in ({"email": "a@b.com"}, {"nombre": "A", "email": "x"}, {"nombre": "A", "telefono": 11}, {"nombre": "A", "email_score": 101}, {"nombre": ""}):
        assert reply(spark, bad).select(replies.reply_reject_reason("v")).first()[0] is not None


def test_prompts(spark):
    table = {r.vertical: r for r in prompts.prompt_table(spark).collect()}
    assert len(table) == 15 and all("```json" in r.prompt and '"email"' in r.prompt for r in table.values())
    assert "Hoteles" in table["hoteles"].prompt and "metadata" in table["hoteles"].prompt
    assert all(f.name in table[v].prompt for v in VERTICALS for f in METADATA_FIELDS[v])
    have = spark.createDataFrame([("hoteles",), ("clinicas",)], "vertical string")
    assert prompts.generate_missing(spark, have).count() == 13
    both = prompts.prompts_or_generic(vertical_dimension(spark), prompts.prompt_table(spark).filter("vertical = 'hoteles'"))
    assert both.filter("prompt like 'Sos un extractor%'").count() == 14


def test_registry(spark):
    assert len(VERTICALS) == 15 and len(COMMERCIAL_STATES) == 5
    assert sum(len(metadata_schema(v)) for v in VERTICALS) == 90
    with pytest.raises(KeyError):
        metadata_schema("otra")


def test_streaks_and_pacing(spark):
    log = [("s", i, f) for i, f in enumerate([True, True, False, True, True, True, True])]
    df = spark.createDataFrame(log, "source string, ts bigint, fail boolean")
    got = crawlplan.failure_streaks(df, bucket=F.floor(F.col("ts") / 2)).orderBy("ts").collect()
    assert [r.streak for r in got] == [1, 2, 0, 1, 2, 3, 4] and [r.open for r in got] == [False] * 5 + [True, True]
    requests = spark.createDataFrame([("d", 0.0, 1), ("d", 1.0, 2), ("d", 10.0, 3), ("d", 10.5, 4)], "domain string, arrival double, ord bigint")
    plan = crawlplan.pacing_plan(requests, 3.0)
    assert [r.slot for r in plan.orderBy("ord").collect()] == [0.0, 3.0, 10.0, 13.0]


def test_chunks_cover_everything(spark):
    df = spark.range(0, 1050).selectExpr("id * 3 AS ord")
    sizes = [r["count"] for r in report.with_chunks(df, "ord", 100).groupBy("chunk_id").count().orderBy("chunk_id").collect()]
    assert sizes == [100] * 10 + [50]


def test_empty_log(spark):
    log = spark.createDataFrame([], "error string, url_usada string, tiene_datos_contacto_llm boolean, todos_los_emails_unificados array<string>, emails_regex array<string>")
    row = report.run_report(log).first()
    assert (row.total, row.pct_sin_web) == (0, 0)


def test_enrichment_run(spark, tmp_path):
    from leadspark.sources.ledger import Ledger

    cand = spark.createDataFrame([
        (1, "Uno", "https://uno.example", "Tigre", None, None, "zonaprop"), (2, "Dos", None, "Pilar", None, None, "zonaprop"),
        (3, "Tres", "https://tres.example", None, None, None, "zonaprop")],
        "ord bigint, nombre string, sitio_web string, partido string, provincia string, localidad string, fuente string")
    pages = spark.createDataFrame([(1, "https://uno.example", "x" * 400), (2, "https://tres.example", "corto")], "page_id bigint, url string, text string")
    answers = spark.createDataFrame([("https://uno.example", '{"nombre": "Uno SA", "email": "a@uno.example", "metadata": {"zona": "Norte"}}')], "url string, reply string")
    verif = spark.createDataFrame([("a@uno.example", "valid", 90, None)], "email string, status string, score int, error string")
    geo = spark.createDataFrame([("Tigre, Buenos Aires, Argentina", -34.0, -58.0, "g")], "query string, lat double, lon double, provider string")
    book = Ledger(spark, str(tmp_path / "ledger"))
    out = jobs.run_enrichment(book, str(tmp_path / "lots"), jobs.RunOptions("barrios_privados"), candidates=cand, page_text=pages,
                              answers=answers, verifications=verif, gazetteer=geo)
    assert (out["discovered"], out["fetched"], out["fetched_ok"], out["validated"], out["geocoded"], out["errors"]) == (3, 2, 1, 1, 1, 1)
    rows = {r.nombre: r for r in spark.read.parquet(str(tmp_path / "lots")).collect()}
    assert set(rows) == {"Uno SA", "Dos", "Tres"} and rows["Uno SA"].email_validado and rows["Uno SA"].latitud == -34.0
    assert rows["Uno SA"].partido == "Tigre" and rows["Dos"].fuente_contacto == "zonaprop"
    assert book.lots().first().leads_count == 3 and book.runs().first().discovered == 3


def test_extraction_with_answers(spark):
    pages = spark.createDataFrame([(1, "A", "u", "mail x@y.com"), (2, "B", "u", ""), (3, "C", "u", "z")], "id bigint, nombre string, url string, text string")
    answers = spark.createDataFrame([(1, "p", [("Ana", "Intendente", "ANA@y.com", None)], ["g@y.com"], None, True),
                                     (3, "p", [("", None, None, None)], [], None, True)],
                                    "id bigint, provider string, contactos array<struct<nombre_completo:string,cargo:string,email:string,telefono:string>>, "
                                    "emails_generales array<string>, telefono_general string, tiene_datos_contacto boolean")
    got = {r.barrio_id: r for r in enrich.extraction_records(pages, answers).collect()}
    assert got["1"].todos_los_emails_unificados == ["ana@y.com", "g@y.com", "x@y.com"]
    assert got["2"].error == "Texto vacío" and got["3"].modelo_usado == "regex_only"


@pytest.mark.parametrize("page, text", [
    ("<nav>a<nav>b</nav>LEAK</nav><p>ok</p>", "ok"),
    ("x<script>var a = '<nav>'; leak", "x"),
    ("<header>h<nav>n</nav>i</header>t<footer>f", "t"),
    ("</nav>keep<NAV class=a>gone</NAV >tail", "keep tail"),
    ("<style>a{}</style><style>b{}</style>z", "z"),
    ("<navy>stay</navy>", "stay"),
    ("<nav>a<nav>b<nav>c</nav>d</nav>e</nav>f<nav>g", "f"),
    (None, ""),
])
def test_dropped_elements_nested_and_unclosed(spark, page, text):
    frame = spark.createDataFrame([(page,)], "html string")
    assert frame.select(html.html_text("html")).first()[0] == text


def test_nothing_is_cut_unless_asked(spark):
    from leadspark.functions.text import join_texts
    from leadspark.operators.enrich import extraction_records
    from leadspark.operators.prompts import batch_requests, contact_requests
    from leadspark.plans.jobs import RunOptions

    assert RunOptions("hoteles").limit is None
    far = " " * 6_000 + "x" * 20_000 + " mail a@b.com"
    pages = spark.createDataFrame([(1, "n", "u", far, "hoteles"), (2, "m", "v", "   ", "hoteles")], "id long, nombre string, url string, text string, vertical string")
    rows = {r.barrio_id: r for r in extraction_records(pages).collect()}
    assert rows["1"].emails_regex == ["a@b.com"] and rows["1"].error is None and rows["2"].error == "Texto vacío"
    assert pages.select(F.length(join_texts("text", "nombre"))).first()[0] == len(far) + 4
    prompts = spark.createDataFrame([("hoteles", "p")], "vertical string, prompt string")
    whole, cut = batch_requests(pages, prompts), batch_requests(pages, prompts, 100)
    assert far in whole.where("id = 1").first().user and not whole.where("id = 1").first().truncated
    assert {r.id: r.truncated for r in cut.collect()} == {1: True, 2: False}
    assert far in contact_requests(pages).where("id = 1").first().user and contact_requests(pages, 5).where("truncated").count() == 1


def test_supplement_gate_has_two_sides(spark):
    base = spark.createDataFrame([("a.com",), ("b.com",)], "sitio_web string")
    extra = spark.createDataFrame([("b.com",), ("c.com",)], "sitio_web string")
    sites = lambda limit: sorted(r[0] for r in discover.supplement(base, extra, limit).collect())
    assert sites(None) == sites(6) == ["a.com", "b.com", "c.com"]
    assert sites(4) == ["a.com", "b.com"]


def test_hot_domains_and_sources_spread(spark):
    """A third of all requests arrive at once for one domain, a third of all attempts come from one source."""
    rng = random.Random(3)
    rows = [(i, "hot" if i % 3 == 0 else rng.choice(["a", "b", None]), 5 if i % 3 == 0 else rng.randrange(40), rng.random() < 0.7) for i in range(2400)]
    df = spark.createDataFrame(rows, "ord long, domain string, arrival long, fail boolean").repartition(4)
    slots, streak = {}, {}
    free, run = {}, {}
    for i, domain, arrival, fail in sorted(rows, key=lambda r: (r[2], r[0])):
        slots[i] = max(arrival, free.get(domain, arrival))
        free[domain] = slots[i] + 3
        run[domain] = run.get(domain, 0) + 1 if fail else 0
        streak[i] = run[domain]
    assert {r.ord: r.slot for r in crawlplan.pacing_plan(df).collect()} == slots
    got = crawlplan.failure_streaks(df, "domain", ["arrival", "ord"])
    assert {r.ord: r.streak for r in got.collect()} == streak and "__slice" not in got.columns
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a table this small would be one range
    try:
        ranges = in_ranges(df, ["domain", "arrival", "ord"]).filter("domain = 'hot' AND arrival = 5").select("__range").distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert ranges > 1


def test_frequent_lookup_equals_left_join(spark):
    rng = random.Random(5)
    rows = [(i, "hot" if i % 3 == 0 else rng.choice(["a", "b", "gone", None, f"k{i}"])) for i in range(900)]
    df = spark.createDataFrame(rows, "ord long, q string")
    lookup = spark.createDataFrame([("hot", 1.0, None), ("a", None, "x"), ("k7", 2.0, "y"), ("unused", 0.0, "z")], "q string, lat double, by string")
    want = sorted(map(str, df.join(lookup, "q", "left").select("ord", "q", "lat", "by").collect()))
    for hot in (1, 3, 5000):
        assert sorted(map(str, frequent_lookup(df, lookup, "q", hot).collect())) == want


def test_requests_leave_pages_where_they_are(spark):
    """Three verticals must not collect all pages in three tasks."""
    from leadspark.operators.prompts import batch_requests, prompt_table

    pages = spark.range(10 ** 9).selectExpr("id", "element_at(array('hoteles', 'clinicas', 'empresas'), int(id % 3) + 1) AS vertical", "repeat('x', 9) AS text")
    plan = batch_requests(pages, prompt_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("BroadcastHashJoin") < plan.index("Exchange hashpartitioning")
    assert batch_requests(pages.limit(50), prompt_table(spark)).count() == 50
