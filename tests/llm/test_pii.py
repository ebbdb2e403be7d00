import hashlib
import math
import re
import time
from collections import Counter, defaultdict

import regex

from conftest import SMALL
from pyspark.sql import functions as F

from loadkit.llm.pii import (BLANK, KINDS, NEAR_CHARS, PATTERNS, SMOOTH, WORD, base_matches, base_spans, disclosing_terms, distinct_texts, entity_terms,
                             find_private, op8_information_sanitiser, sanitise)

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 13 <= len(d) <= 19 and luhn(d) or kind == "phone" and 9 <= len(d) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


HARD = ["a@b.com_x@y.org", "a@b.com.x@y.com", "@x.y a@b a@b.c a.@-.-", "é\U0001f600 x.1@m.de, 1.2.3.4.5.6.7.8 0001.2.3.255 256.1.1.1 1.2.3",
        "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111112 5 4 3 4111111111111111", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9",
        "+1 (555) 010-9999 +49.30.123456 ++123456789 +1-2 +12345678901234567 +1234567 8)", "\n+491701234567\n\n0000000000000", "1." * 50 + "1", ""]


def test_base_spans_equal_the_patterns(spark):
    docs = [(i, t) for i, t in enumerate(HARD)]
    docs += [(r.doc_id + 100, r.text) for r in spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet").collect()]
    got = base_spans(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).select("doc_id", F.concat(*BASE).alias("s")).collect()
    want = dict(docs)
    for r in got:
        assert r.s == brute(want[r.doc_id]), want[r.doc_id][:200]


def test_query(spark):
    rows = {r.doc_id: brute(r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = op8_information_sanitiser(spark, SMALL)
    assert got.columns[:7] == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    for r in got.collect():
        s = rows[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k + ":") for x in s) for k in BASE]
        assert r.base_sha256 == hashlib.sha256(",".join(s).encode()).hexdigest() and r.spans.startswith(",".join(s))


def brute_terms(docs, generalise=0.8, remove=0.95):
    """docs: texts -> {text: ([term spans], [term_removed spans])}, by the definitions."""
    texts = sorted({t or "" for t in docs})
    held = {t: {x.split(":", 1)[1] for x in brute(t)} for t in texts}
    word = regex.compile(WORD)
    blank = regex.compile(BLANK)
    near, n_t = defaultdict(set), Counter()
    for t in texts:
        n_t.update(set(word.findall(t.lower())))
        for kind in KINDS:
            ms = list(regex.compile(PATTERNS[kind]).finditer(t))
            edges = [0, *(m.end() for m in ms)], [*(m.start() for m in ms), len(t)]
            for i, m in enumerate(ms):
                if f"{kind}:{m.start()}:{m.end()}" in brute(t):
                    own = near[m[0].lower(), t]
                    for c in (t[edges[0][i]:edges[1][i]][-NEAR_CHARS:], t[edges[0][i + 1]:edges[1][i + 1]][:NEAR_CHARS]):
                        own |= set(word.findall(blank.sub("\n", c).lower()))
    n, n_e, n_te = max(len(texts), 2), Counter(e for e, _ in near), Counter((e, w) for (e, _), ws in near.items() for w in ws)
    told = {}
    for (e, w), k in n_te.items():
        if not n_t[w]:      # the window's edge cut it off a word
            continue
        p = n_e[e] / max(n, n_e[e] + 1)
        told[e, w] = math.log((k + SMOOTH * p) / (max(n_t[w], k) + SMOOTH) / p) / -math.log(p)
    out = {}
    for t in texts:
        best = {}
        for e in {e for e, x in near if x == t}:
            for (f, w), d in told.items():
                if f == e and d >= generalise:
                    best[w] = max(best.get(w, d), d)
        got = [(m.start(), m.end(), best[m[0].lower()]) for m in word.finditer(t) if m[0].lower() in best]
        out[t] = [[f"{k}:{s}:{e}" for s, e, d in got if (d >= remove) == (k == "term_removed")] for k in ("term", "term_removed")]
    assert held
    return out, told


def corpus():
    texts = [f"Call agent Zorblax at zor@x.org about case {i}.\nThe report on day{i} is long" for i in range(6)]
    texts += ["Call agent Smith about case 9"] * 12 + [f"The report number{i} of the day. Call an agent about the case" for i in range(40)]
    texts += ["Zorblax alone", "Written by Quux for solo@y.org", "Written by Quux for solo@y.org", "Quux\nFinance office\nquux@z.net\n+1 (555) 010-9999\nReport"]
    return texts


def test_terms_equal_brute_force(spark):
    texts = corpus() + [r.text for r in spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet").collect()]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, term string")
    want, told = brute_terms(texts)
    got = {r.doc_id: [r.term, r.term_removed] for r in find_private(docs).collect()}
    for i, t in enumerate(texts):
        assert got[i] == want[t or ""], t[:200]
    assert sum(bool(x[0] or x[1]) for x in got.values()) > 40
    flat = distinct_texts(docs.selectExpr("xxhash64(coalesce(text, '')) AS th", "coalesce(text, '') AS text"))
    pairs = {(r.entity, r.term): r.disclosure for r in disclosing_terms(flat, entity_terms(base_matches(flat)), -99.0).collect()}
    assert pairs.keys() == told.keys() and all(math.isclose(pairs[k], v, abs_tol=1e-9) for k, v in told.items())


def test_what_reveals_an_entity(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, term string")
    words = {r.doc_id: {r.text[int(x.split(":")[1]):int(x.split(":")[2])] for x in r.term + r.term_removed} for r in find_private(docs).collect()}
    assert words[0] == {"Zorblax", "long", "day0"}             # met beside the entity only; "agent", "case", "report" are not
    assert {"Finance", "office"} <= words[len(texts) - 1]       # a contact block
    assert not words[10] and not words[52]                      # no entity, nothing to protect
    clean = {r.doc_id: r.sanitised for r in sanitise(docs, remove=2.0).collect()}
    assert clean[0] == texts[0].replace("Zorblax", "[TERM]").replace("long", "[TERM]").replace("day0", "[TERM]").replace("zor@x.org", "[EMAIL]") and clean[10] == texts[10]
    assert "Zorblax" not in sanitise(docs).filter("doc_id = 0").first().sanitised


def test_contact_blocks(spark):
    texts = [f"Name{i}x Person{i}y\nname{i}@firm.example.com" for i in range(200)] + [f"plain text number{i} of the corpus" for i in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: len(r.term) + len(r.term_removed) for r in find_private(docs).collect()}
    assert all(got[i] >= 2 for i in range(200)) and not any(got[i] for i in range(200, 500))


def test_many_matches_in_one_text(spark):
    text = " ".join(f"user{i}@mail{i % 7}.example.com" for i in range(100_000))
    docs = spark.createDataFrame([(1, text), (2, "short a@b.org")], "doc_id long, text string").repartition(2)
    began = time.time()
    got = {r.doc_id: r for r in find_private(docs).select("doc_id", F.size("email").alias("n"), F.element_at("email", -1).alias("last")).collect()}
    assert got[1].n == 100_000 and got[1].last.endswith(f":{len(text)}") and got[2].n == 1
    clean = {r.doc_id: r.sanitised for r in sanitise(docs).collect()}
    assert clean[1] == " ".join(["[EMAIL]"] * 100_000) and clean[2].endswith("[EMAIL]")
    assert time.time() - began < 120


def test_odd_rows(spark):
    rows = [(None, None), (1, None), (2, ""), (3, "x@y.z " * 3000), (4, "7" * 100_000), (4, "7" * 100_000), (5, "a.b" * 60_000 + "@c"), (6, "+1" * 30_000)]
    docs = spark.createDataFrame([(*r, "q") for r in rows], "doc_id long, text string, email string")
    got = {r.doc_id: r for r in find_private(docs).collect()}
    assert len(got[3].email) == 3000 and got[3].email[-1] == f"email:{2999 * 6}:{2999 * 6 + 5}"
    assert not got[4].card and not got[5].email and not got[1].email
    assert find_private(docs).count() == len(rows) and sanitise(docs).count() == len(rows)
    assert find_private(docs.filter(F.lit(False))).count() == 0
