"""Conversation repair, quality rules and whitening against plain Python."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadspark.llm import queries, rules, turns, whitening

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# ------------------------------------------------------------------ conversations


def brute_audit(codes):
    """Cheapest edits by trying every edit of every row and up to two insertions in a gap."""
    best = None
    options = []
    for c in codes:
        initial, fault = "sua?"[c % 4], c // 4
        row = [("D", "", 3)]
        if fault in (turns.SOUND, turns.CUT_OFF):
            row += [("K", initial, fault), ("R", "u", 2 + fault), ("R", "a", 2 + fault)]
        options.append(row)
    gaps = [("", "", 0), ("I", "u", 2), ("I", "a", 2), ("II", "ua", 4), ("II", "au", 4)]
    for rows in itertools.product(*options):
        for extra in itertools.product(gaps, repeat=len(codes) + 1):
            made, audit, cost = extra[0][1], extra[0][0], extra[0][2]
            for (edit, role, price), (inserted, more, paid) in zip(rows, extra[1:]):
                made, audit, cost = made + role + more, audit + edit + inserted, cost + price + paid
            if re.fullmatch(r"(s?(ua)+)?", made) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def full_cyk(codes):
    """All cuts of all spans."""
    n = len(codes)
    cell = {(i, i + 1): turns.row_cell(c) for i, c in enumerate(codes)}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            found = [turns.combine(cell[i, k], cell[k, i + size]) for k in range(i + 1, i + size)]
            out = found[0]
            for other in found[1:]:
                out = turns._least(out, other)
            cell[i, i + size] = out
    return cell[0, n] if n else turns.insertions()


ALL_CODES = [c + 4 * f for c in range(4) for f in range(3)]


def test_short_conversations_equal_every_edit():
    for n in range(3):
        for codes in itertools.product(ALL_CODES, repeat=n):
            assert turns.accepted(turns.parse(bytes(codes)))[:2] == brute_audit(codes), codes
    rng = random.Random(5)
    for _ in range(40):
        codes = [rng.choice(ALL_CODES) for _ in range(3)]
        assert turns.accepted(turns.parse(bytes(codes)))[:2] == brute_audit(codes), codes


def test_one_cut_of_a_span_equals_all_cuts():
    rng = random.Random(6)
    for n in [0, 1, 2, 5, 9, 17, 33, 40]:
        for _ in range(6):
            codes = bytes(rng.choice(ALL_CODES) for _ in range(n))
            assert turns.parse(codes) == full_cyk(codes)


def linear_repair(codes):
    """Cheapest (cost, audit) by a shortest path over the states of the pattern, row by row."""
    step = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def insert(states):
        todo = True
        while todo:
            todo = False
            for q, (cost, audit) in list(states.items()):
                for x in "ua":
                    if (r := step.get((q, x))) and (r not in states or (cost + 2, audit + "I") < states[r]):
                        states[r], todo = (cost + 2, audit + "I"), True
        return states

    states = insert({"0": (0, "")})
    for c in codes:
        initial, fault = "sua?"[c % 4], c // 4
        new = {}

        def offer(q, value):
            if q and (q not in new or value < new[q]):
                new[q] = value

        for q, (cost, audit) in states.items():
            offer(q, (cost + 3, audit + "D"))
            if fault < 2:
                offer(step.get((q, initial)), (cost + fault, audit + "K"))
                for x in "ua":
                    offer(step.get((q, x)), (cost + 2 + fault, audit + "R"))
        states = insert(new)
    return min(states[q] for q in "0a" if q in states)


def brute_repair(rows):
    """The contract, row by row, for (conv_id, turn, role, text)."""
    by = defaultdict(list)
    for conv_id, turn, role, text in rows:
        by[conv_id]
        shown = [" " if v is None else str(v) for v in (conv_id, turn)]
        fault = zlib.crc32(":".join(shown).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        by[conv_id] += [(turn, role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv_id, turned in by.items():
        turned.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, codes, counts = set(), [], Counter()
        for _, role, text in turned:
            tail = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            if not tail:
                fault = turns.BLANK
            elif (role, text) in seen:
                fault = turns.DUPLICATE
            else:
                fault = turns.SOUND if tail[-1] in ".!?" else turns.CUT_OFF
            seen.add((role, text))
            counts[fault] += 1
            codes.append(turns.code(role[:1], fault))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") or not a[1] for a, b in zip(turned, turned[1:]))
        numbers = [t for t, _, _ in turned if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        cost, audit = linear_repair(codes)
        lines, at, expected = [], 0, "user"
        for edit in audit:
            if edit == "I":
                lines.append(expected + ":")
            elif edit in "KR":
                role = turned[at][1] if edit == "K" else expected
                lines.append(f"{role}:{turned[at][2]}")
            at += edit != "I"
            if edit != "D" and not (lines and len(lines) == 1 and lines[0].startswith("s")):
                expected = "assistant" if lines and lines[-1].startswith("u") else "user"
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv_id] = (gaps, counts[turns.BLANK], counts[turns.DUPLICATE], counts[turns.CUT_OFF], illegal, cost, audit, digest)
    return out


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def collected(df):
    rows = df.select(*COLUMNS).collect()
    out = {r[0]: tuple(r[1:]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    want = brute_repair([(r.conv_id, r.turn, r.role, r.text) for r in docs.collect()])
    assert collected(queries.op12(spark, FOLDER)) == want
    assert len({v[6] for v in want.values()}) > 10


def messy_turns():
    rng = random.Random(9)
    rows = []
    for conv_id in [None, 1, 2, 3, 4, 5]:
        for k in range(rng.choice([1, 4, 30, 90])):
            turn = rng.choice([None, k, k, k, k // 2, -k])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No", "  ", "", None, "a\nb!", f"t {k}?", f"t {k}", "é" * 300 + "."])
            rows += [(conv_id, turn, role, text)] * rng.choice([1, 1, 1, 2])
    rows += [(77, k, "user" if k % 2 == 0 else "assistant", f"turn {k // 40}.") for k in range(400)]
    rows += [(88, 2**62, "user", "x."), (88, -(2**62), "assistant", "y.")]
    return rows


@pytest.mark.parametrize("chunk_rows, fan_in, partitions", [(1024, 16, 4), (3, 2, 4), (7, 3, 9)])
def test_messy_conversations_in_chunks_of_any_size(spark, chunk_rows, fan_in, partitions):
    rows = messy_turns()
    data = spark.createDataFrame(
        [(*r, i, "z") for i, r in enumerate(rows)], "conv_id long, turn long, role string, text string, extra int, TEXT string")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = collected(turns.digested(turns.repair(turns.damaged(data.repartition(3)), chunk_rows, fan_in)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert got == brute_repair(rows)


def test_conversations_without_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert collected(turns.digested(turns.repair(turns.damaged(empty)))) == {}
    dropped = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    gone = spark.createDataFrame([(5, dropped, "user", "hi.")], "conv_id long, turn long, role string, text string")
    got = collected(turns.digested(turns.repair(turns.damaged(gone))))
    assert got == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


# ------------------------------------------------------------------ rules


def brute_measures(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    lines = [x for x in text.split("\n") if WORD.search(x)]
    for line in lines:
        dup += line in seen
        seen.add(line)
    places = defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i:i + 5])].append(i)
    covered = {k for at in places.values() if len(at) > 1 for i in at for k in range(i, i + 5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered),
            sum(any(c.isalpha() for c in w) for w in words), len(lines))


MESSY = [None, "", " \n\t ", "one", "a b c d e " * 7, "\x1fq\x85 r\xa0s", "x | y | z # 1", "l\nl\n\n \nl", "é " * 40, "a b c d e f a b c d e f",
         "w" * 5000, "a a a a a a", "1 2 3 4 5 6 7 8 9 10 11 12", " ".join(f"word{i}" for i in range(30))]


def test_measures_equal_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = sorted((r.doc_id, *brute_measures(r.text)) for r in docs.collect())
    got = rules.ledger(docs)
    assert sorted(tuple(r)[:-1] for r in got.collect()) == want
    for text in MESSY:
        assert rules.measure_text(text) == brute_measures(text), text


def test_messy_ledger_policies_and_ablations(spark):
    data = [(i if i else None, t, "x", 3) for i, t in enumerate(MESSY)] + [(1, "", "x", 3)] * 2
    docs = spark.createDataFrame(data, "doc_id long, text string, TEXT string, bits int")
    rows = rules.ledger(docs)
    found = [r.asDict() for r in rows.collect()]
    assert len(found) == len(data)
    checks = [
        lambda m: m["n_words"] < 10, lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"],
        lambda m: 10 * m["n_symbols"] > m["n_words"], lambda m: 10 * m["n_letter_words"] < 8 * m["n_words"],
        lambda m: not 2 * m["n_words"] <= m["word_chars"] <= 12 * m["n_words"],
        lambda m: 100 * m["n_dup_lines"] > 30 * m["n_lines"], lambda m: m["n_words"] > 1000000,
    ]
    for m in found:
        assert m["bits"] == sum(1 << i for i, fails in enumerate(checks) if fails(m))

    def gone(p, bits):
        names = {r.name for i, r in enumerate(rules.RULES) if bits >> i & 1}
        return bool(names & set(p.any_of)) or (bool(p.several) and len(names & set(p.several)) >= p.least)

    for p in rules.POLICIES:
        judged = rules.judge(rows, p).collect()
        assert [r.kept for r in judged] == [not gone(p, r.bits) for r in judged]
    table = {(r.policy, r.version, r.rule): tuple(r)[3:] for r in rules.ablations(rows).collect()}
    bits = [m["bits"] for m in found]
    for p in rules.POLICIES:
        for name in (*p.any_of, *p.several):
            bit, used = rules.mask((name,)), rules.mask((*p.any_of, *p.several))
            assert table[p.name, p.version, name] == (
                sum(b & bit != 0 for b in bits), sum(gone(p, b) for b in bits),
                sum(gone(p, b) and not gone(p, b & ~bit) for b in bits), sum(b & used == bit for b in bits))
    names = {tuple(r[0]) for r in rows.select(rules.failed_rules()).collect()}
    assert ("few_words",) in names or any("few_words" in n for n in names)
    with pytest.raises(ValueError):
        rules.policy("web", 9)


def test_empty_ledger(spark):
    empty = rules.ledger(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.count() == 0 and rules.judge(empty, rules.POLICIES[0]).count() == 0
    assert rules.ablations(empty).count() == 0


def test_rules_keep_good_and_drop_junk(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = queries.op13(spark, "/root/testdata/sf0.01").filter("NOT base_failed").join(labels, "doc_id")
    share = {r.quality: r.share for r in kept.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.98 and share[0] < 0.1


# ------------------------------------------------------------------ whitening


def brute_whitening(rows, fit="counts"):
    """Exact numbers and the covariance by numpy over all rows."""
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    d = max((len(v) for _, v in usable), default=0)
    xs = [(i, [int(np.floor(64 * float(c))) + 1000000 for c in v] + [1000000] * (d - len(v))) for i, v in usable]
    listed = [x for _, x in xs] if fit == "counts" else [list(t) for t in {tuple(x) for _, x in xs}]
    n = len(listed)
    sums = [sum(col) for col in zip(*listed)]
    dev = {}
    for i, x in xs:
        dev.setdefault(i, []).append(sum((n * a - s) ** 2 for a, s in zip(x, sums)))
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in listed])
    return xs, n, dev, centred.T @ centred / n, sums


def check_whitening(result, rows, fit="counts", components=32):
    xs, n, dev, cov, sums = brute_whitening(rows, fit)
    got = [r.asDict() for r in result.collect()]
    k = min(components, len(cov))
    assert len(got) == len(xs) * k
    values = np.linalg.eigvalsh(cov)[::-1]
    by_id = defaultdict(dict)
    for r in got:
        assert r["n"] == n and r["deviation"] in dev[r["vec_id"]]
        assert abs(r["explained"] - values[r["component"] - 1] / np.trace(cov)) <= 1e-4 * max(r["explained"], 1e-12) + 1e-13
        assert r["identity_error"] <= 1e-4
        by_id[r["vec_id"]].setdefault(r["component"], []).append(r["whitened"])
    return xs, values, by_id, cov, sums, n


def test_query_whitens_all_vectors(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    xs, values, by_id, cov, sums, n = check_whitening(queries.op11(spark, FOLDER), rows)
    y = np.array([[by_id[i][c][0] for c in range(1, 33)] for i, _ in xs])
    y = y - y.mean(axis=0)
    assert np.abs(y.T @ y / n - np.eye(32)).max() < 1e-8
    # Undoing the scale gives projections on unit eigenvectors: V @ q = e q.
    x = np.array([[a - s / n for a, s in zip(row, sums)] for _, row in xs])
    q = np.linalg.lstsq(x, y * np.sqrt(values[:32]), rcond=None)[0]
    assert np.abs(np.linalg.norm(q, axis=0) - 1).max() < 1e-8
    assert np.abs(cov @ q - q * values[:32]).max() < 1e-6 * values[0]


@pytest.mark.parametrize("fit", ["counts", "one"])
def test_messy_vectors(spark, fit):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=4)]) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(80)]  # a hot vector
    rows += [(None, rows[1][1]), (5, rows[2][1]), (5, rows[2][1]), (200, [1.0, 2.0]), (201, [])]
    rows += [(300, None), (301, [1.0, None, 2.0, 3.0]), (302, [float("nan")] * 4), (303, [float("-inf"), 1.0, 1.0, 1.0])]
    data = spark.createDataFrame([(*r, 1, "e") for r in rows], "vec_id long, embedding array<double>, label int, EMBEDDING string")
    whitening_hot = whitening.HOT_SHARE
    try:
        whitening.HOT_SHARE = 4
        check_whitening(whitening.whiten(data, weights=fit), rows, fit)
        check_whitening(whitening.whiten(data, components=2, weights=fit), rows, fit, components=2)
    finally:
        whitening.HOT_SHARE = whitening_hot


def test_vectors_without_variance_or_of_any_size(spark):
    def run(rows):
        return whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()

    assert run([]) == [] and run([(1, []), (2, None)]) == []
    alone = run([(1, [0.5, 1.0])])
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [
        (1, 1, 0, 0.0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0, 0.0)]
    line = run([(i, [float(i), 2.0 * i]) for i in range(5)])
    assert {r.whitened for r in line if r.component == 2} == {0.0} and line[0].identity_error < 1e-9
    huge = run([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [2.0**60, 2.0])])
    assert len(huge) == 6 and all(np.isfinite(r.whitened) for r in huge) and {r.deviation for r in huge} == {None}
    with pytest.raises(ValueError):
        whitening._weight("other")
