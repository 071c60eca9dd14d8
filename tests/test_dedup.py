"""Exact and fuzzy de-duplication: known cases and brute-force twins."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadspark.functions import text
from leadspark.functions.text import normalize_name, token_sort_ratio
from leadspark.operators import dedup, similarity
from leadspark.session import cut_lineage


def leads(spark, rows):
    data = [(i, n, p) for i, (n, p) in enumerate(rows)]
    return spark.createDataFrame(data, "ord bigint, nombre string, partido string")


def kept(df):
    return [r["nombre"] for r in df.orderBy("ord").collect()]


EXACT = [
    ([("Nordelta", "Tigre"), ("Nordelta", "Tigre")], 1),
    ([("Nordelta", "Tigre"), ("NORDELTA", "TIGRE")], 1),
    ([("El Cantón", "Escobar"), ("El Canton", "Escobar")], 1),
    ([("El  Cantón", "Escobar"), ("El Cantón", "Escobar")], 1),
    ([("Los Eucaliptos", "Pilar"), ("Los Eucaliptos", "Tigre")], 2),
    ([], 0),
]


@pytest.mark.parametrize("rows,n", EXACT)
def test_exact(spark, rows, n):
    assert dedup.dedup_exact(leads(spark, rows)).count() == n


def test_exact_order_and_counts(spark):
    df = leads(spark, [("C", "Tigre"), ("A", "Pilar"), ("B", "Escobar")])
    assert kept(dedup.dedup_exact(df)) == ["C", "A", "B"]
    same = leads(spark, [("A", "x")] * 3)
    assert dedup.count_duplicates(same).first()[0] == 2
    groups = dedup.duplicate_groups(leads(spark, [("Nordelta", "Tigre"), ("nordelta", "tigre"), ("El Cantón", "Escobar")]))
    assert [r["group_size"] for r in groups.collect()] == [2, 2]
    assert dedup.count_duplicates(leads(spark, [])).first()[0] == 0


FUZZY = [
    ([("Hotel Intercontinental", "Retiro"), ("Intercontinental Hotel", "Retiro")], 85, ["Hotel Intercontinental"]),
    ([("Nordelta", "Tigre"), ("Nordelta Country", "Tigre")], 85, ["Nordelta", "Nordelta Country"]),
    ([("Clinica Bazterrica", "Retiro"), ("Clinica Bazterrica SA", "Retiro")], 85, ["Clinica Bazterrica"]),
    ([("Parque Industrial Pilar", "Pilar"), ("Parque Industrial de Pilar", "Lujan")], 85, 2),
    ([("Parque Industrial Pilar", "Pilar"), ("Parque Industrial de Pilar", "Pilar")], 85, 1),
    ([("Clinica Bazterrica SA", ""), ("Clinica Bazterrica", "Retiro")], 85, 1),
    ([("Hotel Alvear", "Retiro"), ("Hotel Alvear Palace", "Retiro")], 85, 2),
    ([("Hotel Alvear", "Retiro"), ("Hotel Alvear Palace", "Retiro")], 70, 1),
    ([("Nordelta", None)], 85, 1),
    ([], 85, 0),
    ([("", None), ("", None), ("x", None)], 85, 2),
]


@pytest.mark.parametrize("threshold", [85, 70])
def test_fuzzy(spark, threshold):
    cases = [(rows, expected) for rows, t, expected in FUZZY if t == threshold]
    data = [(c, c * 100 + i, n, p) for c, (rows, _) in enumerate(cases) for i, (n, p) in enumerate(rows)]
    df = spark.createDataFrame(data, "case int, ord bigint, nombre string, partido string")
    got = {c: [] for c in range(len(cases))}
    for r in dedup.dedup_fuzzy(df, threshold=threshold, by=["case"]).orderBy("ord").collect():
        got[r["case"]].append(r["nombre"])
    for c, (_, expected) in enumerate(cases):
        assert got[c] == expected if isinstance(expected, list) else len(got[c]) == expected


@pytest.mark.parametrize("a,b,score", [
    ("hotel intercontinental", "Intercontinental Hotel", 100), ("Nordelta", "Nordelta Country", 67),
    ("Clinica Bazterrica", "Clinica Bazterrica SA", 92),
    ("Parque Industrial Pilar", "Parque Industrial de Pilar", 94), ("Hotel Alvear", "Hotel Alvear Palace", 77),
    ("", "", 100),
])
def test_native_ratio(spark, a, b, score):
    row = spark.createDataFrame([(a, b)], "a string, b string").select(token_sort_ratio("a", "b")).first()
    assert round(row[0]) == score


# ------------------------------------------------------------ brute force


def lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        cur = [0]
        for j, y in enumerate(b):
            cur.append(prev[j] + 1 if x == y else max(prev[j + 1], cur[-1]))
        prev = cur
    return prev[-1]


def s_of(name):
    return " ".join(sorted(name.lower().split()))


def reaches(a, b, t):
    return 200 * lcs_dp(a, b) >= t * (len(a) + len(b))


def random_names(rng, n, words, longest=3):
    out = []
    for _ in range(n):
        name = list(" ".join(rng.choice(words) for _ in range(rng.randint(0, longest))))
        for _ in range(rng.randint(0, 3)):
            if name and rng.random() < 0.6:
                i = rng.randrange(len(name))
                if rng.random() < 0.5:
                    del name[i]
                else:
                    name.insert(i, rng.choice("abcde "))
        out.append("".join(name).strip())
    return out


WORDS = ["sur", "norte", "el", "la", "pilar", "hotel", "club", "parque industrial", "a", "de", "country", "bc"]


def test_lcs_length(spark):
    """Texts on both sides of every word border, also with characters outside the basic plane."""
    rng = random.Random(3)
    rows = []
    for n in [0, 1, 30, 61, 62, 63, 64, 124, 125, 190]:
        for m in [0, 1, 30, 61, 62, 63, 64, 124, 125, 190]:
            for letters in ("ab", "abcdefghij é\U0001d11e"):
                rows.append(("".join(rng.choice(letters) for _ in range(n)), "".join(rng.choice(letters) for _ in range(m))))
    found = spark.createDataFrame(rows, "a string, b string").select("a", "b", text.lcs_length("a", "b").alias("n")).collect()
    assert [r.n for r in found] == [lcs_dp(r.a, r.b) for r in found] and len(found) == len(rows)


def test_gram_codes_are_bags(spark):
    """Common codes of two texts count their common grams with repetition; signatures never hide one."""
    rng = random.Random(4)
    names = ["", "a", "aa", "aaa", "abab"] + ["".join(rng.choice("abc ") for _ in range(rng.randint(0, 70))) for _ in range(60)]
    df = spark.createDataFrame([(s,) for s in names], "s string")
    for size in (1, 2):
        rows = df.select("s", similarity.gram_codes("s", size).alias("codes")).withColumn(
            "bits", similarity.gram_signature(F.col("codes"))).withColumn("letters", similarity.letter_signature("s")).collect()
        for a, b in zip(rows, rows[7:]):
            def bag(s):
                return Counter(s[i:i + size] for i in range(len(s) - size + 1)) if s else Counter([""])

            common = sum((bag(a.s) & bag(b.s)).values())
            assert len(set(a.codes) & set(b.codes)) == common and len(set(a.codes)) == len(a.codes)
            differing = sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(a.bits, b.bits))
            assert differing <= len(a.codes) + len(b.codes) - 2 * common
            edits = len(a.s) + len(b.s) - 2 * lcs_dp(a.s, b.s)
            assert sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(a.letters, b.letters)) <= edits


@pytest.mark.parametrize("threshold,block_rows", [(85, 20_000), (70, 5), (60, 20_000), (100, 20_000), (92, 3)])
def test_pairs_equal_nested_loop(spark, threshold, block_rows):
    rng = random.Random(threshold)
    names = sorted({s_of(n) for n in random_names(rng, 150, WORDS)})
    df = spark.createDataFrame(list(enumerate(names)), "id bigint, s string")
    got = {(min(r.id_a, r.id_b), max(r.id_a, r.id_b))
           for r in similarity.similar_pairs(df, threshold=threshold, block_rows=block_rows).collect()}
    want = {(i, j) for i in range(len(names)) for j in range(i + 1, len(names)) if reaches(names[i], names[j], threshold)}
    assert got == want


def greedy(rows, t):
    keep = [True] * len(rows)
    for i, (a, p) in enumerate(rows):
        if not keep[i]:
            continue
        for j in range(i + 1, len(rows)):
            b, q = rows[j]
            p1, q1 = (p or "").lower(), (q or "").lower()
            if keep[j] and reaches(s_of(a), s_of(b), t) and (not p1 or not q1 or p1 == q1):
                keep[j] = False
    return [i for i, k in enumerate(keep) if k]


@pytest.mark.parametrize("seed,threshold,first_batch", [(1, 85, 1000), (2, 70, 20)])
def test_greedy_equals_sequential(spark, seed, threshold, first_batch):
    rng = random.Random(seed)
    names = random_names(rng, 120, WORDS)
    rows = [(n, rng.choice(["Tigre", "Pilar", "", None])) for n in names]
    got = [r["ord"] for r in dedup.dedup_fuzzy(leads(spark, rows), threshold=threshold, first_batch=first_batch)
           .orderBy("ord").collect()]
    assert got == greedy(rows, threshold)


def test_dense_cluster(spark):
    rows = [(f"Customer#{i:06d}", "x") for i in range(60)]
    got = [r["ord"] for r in dedup.dedup_fuzzy(leads(spark, rows), first_batch=8).orderBy("ord").collect()]
    assert got == greedy(rows, 85)


def test_matches_equal_nested_loop(spark):
    rng = random.Random(9)
    names = random_names(rng, 70, WORDS)
    rows = [(n, rng.choice(["Tigre", "Pilar", None])) for n in names]
    df = leads(spark, rows)
    got = [(r.ord_a, r.ord_b, r.match_type) for r in dedup.find_fuzzy_matches(df).collect()]
    want = []
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            a, b = s_of(rows[i][0]), s_of(rows[j][0])
            if reaches(a, b, 85):
                score = 200.0 * lcs_dp(a, b) / (len(a) + len(b)) if a or b else 100.0
                same = rows[i][1] and rows[i][1] == rows[j][1]
                want.append((-score, i, j, "nombre+partido" if same else "nombre"))
    want.sort()
    assert got == [w[1:] for w in want]
    top = [(r.ord_a, r.ord_b, r.match_type) for r in dedup.top_matches(df, k=7).collect()]
    assert top == got[:7]
    total = dedup.name_pairs(df).selectExpr("sum(pairs)", "sum(pairs_same_district)").first()
    assert (total[0], total[1]) == (len(want), sum(w[3] == "nombre+partido" for w in want))


PRODUCTION = [
    ([("Hotel Intercontinental", "Retiro")], [("Intercontinental Hotel", "Retiro")], 0, 1),
    ([("Nordelta", "Tigre")], [("Nordelta", "Tigre")], 0, 0),
    ([("Hotel Nuevo", "Palermo")], [("Hotel Viejo", "Tigre")], 1, 0),
    ([("Hotel Nuevo", "")], [], 1, 0),
    ([], [("Nordelta", "Tigre")], 0, 0),
]


@pytest.mark.parametrize("new,prod,n_unique,n_match", PRODUCTION)
def test_production_cases(spark, new, prod, n_unique, n_match):
    unique, matches = dedup.dedup_vs_production(leads(spark, new), leads(spark, prod))
    assert (unique.count(), matches.count()) == (n_unique, n_match)


@pytest.mark.parametrize("any_match", [False, True])
def test_production_equals_nested_loop(spark, any_match):
    rng = random.Random(5)
    new = [(n, rng.choice(["Tigre", "Pilar", None])) for n in random_names(rng, 60, WORDS)]
    prod = [(n, rng.choice(["Tigre", "Pilar", "Lujan", None])) for n in random_names(rng, 60, WORDS)]

    def key(r):
        return (" ".join(r[0].lower().split()), (r[1] or "").lower())

    def compatible(p, q):
        return not p or not q or p == q

    keys = {key(r) for r in prod}
    want_unique, want_match = [], []
    for i, r in enumerate(new):
        if key(r) in keys:
            continue
        best, at = 0.0, None
        hit = False
        for j, q in enumerate(prod):
            a, b = s_of(r[0]), s_of(q[0])
            score = 200.0 * lcs_dp(a, b) / (len(a) + len(b)) if a or b else 100.0
            if any_match and score >= 85 and compatible(r[1], q[1]):
                hit = True
            if score > best:
                best, at = score, j
        if not any_match:
            hit = best >= 85 and compatible(r[1], prod[at][1])
        if hit:
            want_match.append((i, at) if not any_match else i)
        else:
            want_unique.append(i)
    unique, matches = dedup.dedup_vs_production(leads(spark, new), leads(spark, prod), any_match=any_match)
    assert sorted(r["ord"] for r in unique.collect()) == want_unique
    got = sorted((r.ord_a, r.ord_b) if not any_match else r.ord_a for r in matches.collect())
    assert got == want_match


def test_title_queries_equal_nested_loop(spark):
    """The named title queries have no SQL twin: plain Python over the smallest pages table instead."""
    import unicodedata

    from conftest import SF
    from leadspark.catalog import QUERIES
    from leadspark.catalog.registry import Tables
    from leadspark.catalog.views import v_title

    def norm(x):
        folded = "".join(c for c in unicodedata.normalize("NFD", x.lower()) if unicodedata.category(c) != "Mn")
        return " ".join(folded.split())

    rows = [(r.ord, " ".join(sorted(norm(r.nombre).split())), norm(r.partido)) for r in v_title(Tables(spark, SF)).orderBy("ord").collect()]
    kept, pairs = [], 0
    for i, (o, s, d) in enumerate(rows):
        pairs += sum(reaches(s, q, 75) for _, q, _ in rows[:i])
        if not any(reaches(s, q, 75) and (not d or not e or d == e) for _, q, e in kept):
            kept.append((o, s, d))
    got = sorted(r.ord for r in QUERIES["w2_dedup_fuzzy_titles"](spark, SF).collect())
    assert got == [o for o, _, _ in kept]
    assert (QUERIES["j3_page_titles"](spark, SF).selectExpr("coalesce(sum(pairs), 0)").first()[0]) == pairs


def test_connected_components(spark):
    from leadspark.operators.components import connected_components

    rng = random.Random(2)
    links = [(i, i + 1) for i in range(1000, 1300)] + [(5000, i) for i in range(5001, 5200)] + [(7, 7)]
    links += [(rng.randrange(400), rng.randrange(400)) for _ in range(180)]
    root = {n: n for link in links for n in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= (root[a], root[b]) != (low, low)
            root[a] = root[b] = low
    rng.shuffle(links)
    linked = {n for a, b in links if a != b for n in (a, b)}
    got = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((n, root[n]) for n in linked)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("fold_rows", [0, 3, 10_000])
def test_folds_and_rounds_agree(spark, monkeypatch, fold_rows):
    """Components settled by folds, by rounds or by both give the sequential scan."""
    monkeypatch.setattr(dedup, "FOLD_ROWS", fold_rows)
    rng = random.Random(12)
    rows = [(n, rng.choice(["Tigre", "", None, "Pilar"])) for n in random_names(rng, 90, WORDS)]
    df = leads(spark, rows)
    assert [r.ord for r in dedup.dedup_fuzzy(df, threshold=75).select("ord").orderBy("ord").collect()] == greedy(rows, 75)


def test_first_row_of_key_keeps_payload_out_of_sorts(spark):
    from leadspark.operators.grouping import first_per_group, first_row_of_key

    rows = [(i, k, d, "x" * i) for i, (k, d) in enumerate([("a", ""), ("a", None), ("a", ""), (None, "a"), ("a1", ":"), ("a", "1:"), (None, "a"), ("", "-")])]
    df = spark.createDataFrame(rows, "ord long, k string, d string, body string")
    for last in (False, True):
        got = first_row_of_key(df, ["k", "d"], "ord", last)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, first_per_group(df, ["k", "d"], ["ord"], last).collect()))
        assert got.columns == df.columns
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    assert first_row_of_key(df.limit(0), ["k"], "ord").count() == 0


def test_sorted_positions_split_equal_scores(spark):
    """A third of all rows share a score: they lie in several ranges and keep their places."""
    from leadspark.operators.grouping import sorted_positions

    rng = random.Random(6)
    rows = [(100.0 if rng.random() < 0.34 else rng.choice([85.0, 90.5, 99.0]), i, rng.randrange(50)) for i in range(3000)]
    rng.shuffle(rows)
    order = [F.desc("score"), F.asc("ord_a"), F.asc("ord_b")]
    df = spark.createDataFrame(rows, "score double, ord_a long, ord_b long").repartition(5)
    got = {(r.score, r.ord_a, r.ord_b): r.n for r in sorted_positions(df, order).collect()}
    assert got == {row: n for n, row in enumerate(sorted(rows, key=lambda r: (-r[0], r[1], r[2])), 1)}
    spread = df.repartitionByRange(4, *order).filter("score = 100").select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread > 1
    assert sorted_positions(df.limit(0), order).count() == 0


def test_crawl_permission_equals_rule_by_rule(spark):
    from leadspark.operators.crawlplan import crawl_permission

    rng = random.Random(7)
    paths = ["", "/", "/a", "/a/b", "/ab", "/a?x=1", "/b", None, "/a/b/c", "é/"]
    rules = [(f"d{rng.randrange(4)}.com", seq, rng.random() < 0.5, rng.choice(paths)) for seq in range(60)]
    urls = [f"https://{rng.choice(['', 'www.'])}d{rng.randrange(6)}.com{p or ''}{q}" for p in paths for q in ("", "/b/c/d", "?x=1&y", "#f") for _ in range(4)]
    got = {r.url: r.allowed for r in crawl_permission(
        spark.createDataFrame([(u,) for u in urls], "url string"),
        spark.createDataFrame(rules, "domain string, seq int, allow boolean, path string")).collect()}
    for url in urls:
        rest = url.split("//", 1)[1]
        host = rest.replace("#", "/").replace("?", "/").split("/", 1)[0]
        tail = rest[len(host):].split("#")[0]
        path = tail.split("?")[0] or "/"
        whole = path + ("?" + tail.split("?", 1)[1] if "?" in tail else "")
        domain = host[4:] if host.startswith("www.") else host
        hits = [(seq, allow) for d, seq, allow, start in rules if d == domain and start is not None and whole.startswith(start)]
        assert got[url] == (min(hits)[1] if hits else True), url


@pytest.mark.parametrize("start, letters, lengths, threshold", [
    ("cust#00", "0123", (4, 5, 6), 85), ("", "abc", (0, 1, 2, 3, 4, 5), 60), ("xyz", "ab", (3, 7), 90), ("a", "ab", (1, 2), 50)])
def test_common_keys_give_every_pair(spark, start, letters, lengths, threshold):
    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
        return row[-1]

    rnd = random.Random(5)
    names = sorted({start + "".join(rnd.choice(letters) for _ in range(rnd.choice(lengths))) for _ in range(150)})
    want = {(i, j) for i, a in enumerate(names) for j, b in enumerate(names) if i < j and 200 * common(a, b) >= threshold * (len(a) + len(b))}
    df = spark.createDataFrame(list(enumerate(names)), "id long, s string")
    assert similarity.common_keys([df], threshold) is not None
    assert sorted(tuple(sorted(r)) for r in similarity.similar_pairs(df, None, threshold, scored=False).collect()) == sorted(want)
    two = similarity.similar_pairs(df.filter("id % 2 = 0"), df.filter("id % 2 = 1"), threshold).select("id_a", "id_b").collect()
    assert sorted(tuple(sorted(r)) for r in two) == sorted((i, j) for i, j in want if i % 2 != j % 2)


def test_numbered_names_take_common_keys(spark):
    # 900,000 numbered names have 15 keys each; pairs of gram blocks grew with the square of the table.
    cases = similarity._key_cases({6: 900_000}, 12, 85)
    assert cases == {6: [(6, 6, 4)]}
    assert similarity._key_cases({33: 100}, 0, 85) is None


def test_best_matches_stop_at_the_threshold_that_gives_enough(spark, monkeypatch):
    rows = leads(spark, [(f"Planta#{i:09d} {where}", where) for i in range(60) for where in ("Pilar", "Tigre", "Quilmes")])
    want = [tuple(r) for r in dedup.find_fuzzy_matches(rows).limit(20).collect()]
    asked, real = [], dedup.similar_pairs
    monkeypatch.setattr(dedup, "similar_pairs", lambda *a, **k: asked.append(k["threshold"]) or real(*a, **k))
    assert [tuple(r) for r in dedup.top_matches(rows, 20).collect()] == want
    assert asked and min(asked) > 90
    few = leads(spark, [("Uno", "a"), ("Uno", "b"), ("Unos", "a"), ("Cerro", "a")])
    assert [tuple(r) for r in dedup.top_matches(few, 20).collect()] == [tuple(r) for r in dedup.find_fuzzy_matches(few).collect()]


def test_blocks_of_whole_names_find_every_pair(spark, monkeypatch):
    """Titles whose grams are common: blocks against all pairs by plain Python, one and two sides, and the cost they are chosen by."""
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    rnd = random.Random(12)
    parts = ["the", "er", "ing", "tion", "nd", "é日", "🙂a"]
    texts = sorted({"".join(rnd.choice(parts) for _ in range(rnd.randint(0, 18)))[:64] for _ in range(140)} | {""})
    monkeypatch.setattr(similarity, "CELL_ROWS", 17)
    nodes = spark.createDataFrame(list(enumerate(texts)), "id long, s string")
    left, right = nodes.filter("id % 3 = 0"), nodes.filter("id % 3 > 0").unionByName(spark.createDataFrame([(1000, "")], "id long, s string"))
    for threshold in (75, 60.5):
        assert similarity._cells_of([nodes], threshold) == [-(-len(texts) // 17)]
        score = {(i, j): 100.0 if not a + b else 200.0 * lcs(a, b) / len(a + b) for i, a in enumerate(texts) for j, b in enumerate(texts)}
        want = {k: v for k, v in score.items() if k[0] < k[1] and v >= threshold}
        found = similarity.similar_pairs(nodes, threshold=threshold).collect()
        assert len(found) == len(want) > 5 and {(min(r[:2]), max(r[:2])): r.score for r in found} == want
        want = {k: v for k, v in score.items() if k[0] % 3 == 0 and k[1] % 3 and v >= threshold} | {(0, 1000): 100.0}
        found = similarity.similar_pairs(left, right, threshold, scored=False).collect()
        assert sorted(tuple(r) for r in found) == sorted(want)
    assert similarity._cells_of([spark.createDataFrame([(1, "a" * 65), (2, "a" * 64)], "id long, s string")], 75) is None
    rare = spark.createDataFrame([(i, "".join(chr(0x4E00 + rnd.randrange(9000)) for _ in range(20))) for i in range(300)], "id long, s string")
    assert similarity._cells_of([rare], 75) is None  # few pairs meet: gram blocks


def test_gram_counts_are_those_of_the_expression(spark):
    """Counted by array steps or by expressions: the same grams with the same occurrence numbers, under other codes."""
    texts = ["", "a", "ana banana", "é日🙂é日", "aaaa", "ab ab"]
    for size in (1, 2):
        codes = spark.createDataFrame([(t,) for t in texts], "s string").select(F.explode(similarity.gram_codes("s", size)).alias("c"))
        want = sorted(r["count"] for r in codes.groupBy("c").count().collect())
        counts = similarity._gram_counts(texts, size)
        assert len(counts) == similarity.GRAM_BUCKETS and sorted(counts[counts > 0].tolist()) == want
    assert similarity._gram_counts([], 2).sum() == 0


def test_few_pairs_of_a_block_cost_the_whole_subsequence(monkeypatch):
    """Names of like letters in another order pass the letter counts; the order of some letters tells most of them apart."""
    rnd = random.Random(4)
    letters = "the one of and in to is that it was for on are as with his they"
    names = ["".join(rnd.choice(letters) for _ in range(60)) for _ in range(150)]
    names += [name[:50] + name[:9:-1][:10] for name in names[:20]]
    whole, real = [], similarity._lcs_steps
    monkeypatch.setattr(similarity, "_lcs_steps", lambda rows, size, kind: (whole.append(size) if kind is np.uint64 else None, real(rows, size, kind))[1])

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    i, j, score = similarity.block_lcs(names, names, 75, True)
    want = {(x, y): 100 * lcs(names[x], names[y]) / 60 for x in range(len(names)) for y in range(x + 1, len(names))}
    want = {pair: value for pair, value in want.items() if value >= 75}
    assert len(want) >= 20 and dict(zip(zip(i.tolist(), j.tolist()), score.tolist())) == pytest.approx(want)
    alike = sum((Counter(a) & Counter(b)).total() >= 45 for x, a in enumerate(names) for b in names[:x])
    assert len(want) <= sum(whole) < alike / 4, (whole, alike)


@pytest.mark.parametrize("names", ["numbered", "free"])
def test_growing_sides_are_not_broadcast(spark, tmp_path, monkeypatch, names):
    """Files of a few KB make the estimates small; no step of the de-duplication may take its tables to the driver for that."""
    from leadspark.operators import components, quality

    name = "concat('Customer#', lpad(id, 6, '0'))" if names == "numbered" else "concat_ws(' ', hex(id * 7919), repeat(chr(65 + id % 26), 1 + id % 9), 'sa')"
    spark.range(300).selectExpr("id AS ord", f"{name} AS nombre", "CAST(id % 3 AS STRING) AS partido", "'v' AS vertical").write.parquet(str(tmp_path / "t"))
    rows = dedup.with_name_keys(spark.read.parquet(str(tmp_path / "t")))
    joins = []

    def seen(df):
        joins.extend(re.findall(r"\w*Join\w*", df._jdf.queryExecution().executedPlan().toString()))
        return cut_lineage(df)

    for module in (dedup, similarity, components, quality):
        monkeypatch.setattr(module, "cut_lineage", seen)
    nodes = rows.selectExpr("ord AS id", "__s", "__d", "vertical")
    kept = seen(dedup.fuzzy_survivors(nodes, 85, ["vertical"], first_batch=50))
    assert kept.count() > 0
    assert set(joins) == {"SortMergeJoin"} and len(joins) > 20
