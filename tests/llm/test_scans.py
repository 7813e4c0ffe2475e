"""Secret and license scans against plain Python."""

import hashlib
import re
from collections import Counter

import duckdb

from monthclose.llm import license_scan, registry, secret_scan
from .conftest import ROWS

BASE = (
    ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
)


def base_spans(text):
    found = []
    for number, (kind, regex, group, least) in enumerate(BASE):
        for m in re.finditer(regex, text or "", re.ASCII):
            if len(m[group]) >= least:
                found.append((m.start(), number, m.end(), kind))
    return sorted(found)


def test_spans_equal_plain_regexes(docs):
    found = secret_scan.scan(docs).collect()
    kinds = len(secret_scan.BASE_RULES)
    got = Counter((r.doc_id, tuple((s.start, s.rule, s.end) for s in r.spans if s.rule < kinds)) for r in found)
    assert got == Counter((i, tuple(s[:3] for s in base_spans(t))) for i, t, *_ in ROWS)
    assert sum(len(base_spans(t)) for _, t, *_ in ROWS) >= 5


def test_added_kinds_keep_the_base(spark):
    text = "ghp_" + "a1" * 18 + " xoxb-1234567890ab token=abcdefgh"
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = secret_scan.scan(rows).select(secret_scan.listed("spans").alias("s")).first().s.split(",")
    assert f"github:0:{40}" in spans and "slack:41:58" in spans and "assign:59:73" in spans


def test_trigram_queries():
    assert secret_scan.trigram_query("AKIA[A-Z0-9]+") == [frozenset({"aki", "kia"})]
    assert secret_scan.trigram_query("[0-9a-f]{24,}") is None
    keys = secret_scan.trigram_query(BASE[0][1])
    assert frozenset({"tok", "oke", "ken"}) in keys and frozenset({"api", "pik", "ike", "key"}) in keys
    assert secret_scan.trigram_query("ab?c") is None
    assert secret_scan.trigram_query("abc.*def") == [frozenset({"abc", "def"})]


def test_postings_hold_every_text_with_a_match(docs):
    """The query of a rule must hold for every text its regex matches."""
    for rule in secret_scan.RULES:
        query = secret_scan.trigram_query(rule.regex)
        for _, text, *_ in ROWS:
            if query and text and re.search(rule.regex, text):
                assert any(all(t in text.lower() for t in clause) for clause in query)


def test_empty_table(nothing):
    assert secret_scan.scan(nothing).count() == 0
    assert license_scan.scan(nothing).count() == 0


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def test_license_places_and_labels(docs):
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    want = Counter()
    for i, text, *_ in ROWS:
        w, places = words(text), []
        for phrase, label in phrases.items():
            p = phrase.split()
            places += [(k, label) for k in range(len(w)) if w[k : k + len(p)] == p]
        starts = [k for k, _ in places] or [None]
        want[(i, len(w), len(places), starts and min(starts, key=lambda x: x or 0), max(starts, key=lambda x: x or 0), tuple(sorted({x for _, x in places})))] += 1
    found = license_scan.scan(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, tuple(r.base_labels)) for r in found) == want
    assert all(set(r.base_labels) <= set(r.labels) and 0 <= r.score <= 1 for r in found)


def test_blocks_equal_all_pairs(spark):
    """Prefix, length and position filters lose no block that holds enough of a template."""
    import math
    import random

    draw = random.Random(3)
    members = [sorted(license_scan._set(t)) for _, t in license_scan.TEMPLATES]
    rows = []
    for i in range(120):
        of = draw.choice(members)
        kept = [w for w in of if draw.random() < draw.choice((0.85, 0.95, 1.0))] + draw.sample(["noise", "under", "the", "more"], 2)
        draw.shuffle(kept)
        rows.append((i, " ".join(kept) + "\nother line"))
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in found:
        text = dict(rows)[r.doc_id]
        want = set(r.base_labels)
        for line in [*text.split("\n"), text]:
            held = set(words(line))
            for label, t in license_scan.TEMPLATES:
                t = license_scan._set(t)
                if len(held & t) >= math.ceil(license_scan.THRESHOLD * len(t) - 1e-9):
                    want.add(label)
        assert set(r.labels) == want, text


def test_hash_of_the_base_spans(spark):
    import corpus_pipeline  # noqa: F401  the pipeline's module imports without a session
    from monthclose.llm.registry import QUERIES

    found = QUERIES["op1_secret_scan"](spark, "/root/testdata/sf0.001")
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in found.collect():
        listed = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in base_spans(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()


def test_positions_of_many_matches_in_one_text(spark):
    """Short and long matches in turn, beside code points of several bytes; a text of any number of blocks."""
    texts = [("é token=abcdef12 x token=ab\n" * n) + "𝔘 secret:tail-end" * (n % 2) for n in (0, 1, 2, 3, 7, 50, 4_000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secret_scan.scan(rows).collect():
        assert [tuple(s) for s in r.spans] == [s[:3] for s in base_spans(texts[r.doc_id])]


def test_sql_gives_the_same_spans(spark, tmp_path):
    texts = [t for _, t, *_ in ROWS] + ["token=abcdef12 x token=ab" * 30, "é" + "ab12" * 9 + " " + "cd34" * 9, "xoxb-1234567890ab"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    wanted = {r[0]: r[1:] for r in con.execute("SELECT doc_id, base_sha256, spans FROM (" + registry.SQL["op1_secret_scan"] + ")").fetchall()}
    found = registry.QUERIES["op1_secret_scan"](spark, str(tmp_path)).select("doc_id", "base_sha256", "spans").collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == wanted and len(wanted) == len(texts)
