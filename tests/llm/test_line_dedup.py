import re
from collections import Counter, defaultdict

from conftest import SMALL
from pyspark.sql import functions as F

from loadkit.llm.line_dedup import DEPTH, FIXED_SHARE, drop_recurring, op4_line_dedup

SOLID = r"[^\x20\x09-\x0D]"


def brute(docs, min_docs):
    """docs: (doc_id, text) -> {doc_id: (n_lines, n_dropped, text)}, by the definitions."""
    toks = lambda s: re.findall(SOLID + "+", s)
    leaf = lambda s: (len(toks(s)), *("<*>" if re.search("[0-9]", t) else t for t in toks(s)[:DEPTH]))
    places = []
    for d, t in docs:
        lines = [x for x in (t or "").split("\n") if re.search(SOLID, x)]
        longest = list(dict.fromkeys(leaf(x) for x in sorted(lines, key=len, reverse=True)))[:3]
        places += [(d, t, x, leaf(x), tuple([f for f in longest if f != leaf(x)][:2])) for x in lines if len(toks(x)) >= DEPTH]
    crowd = defaultdict(set)
    for _, t, _, f, _ in places:
        crowd[f].add(t)
    places = [p for p in places if len(crowd[p[3]]) >= min_docs]
    n = Counter(x for _, x in {(p[1], p[2]) for p in places})
    at = Counter()
    for x in n:
        for i, t in enumerate(toks(x)):
            at[leaf(x), i, t] += n[x]
    shape = {}
    for x in n:
        s = [t if not re.search("[0-9]", t) and at[leaf(x), i, t] >= min_docs else "<*>" for i, t in enumerate(toks(x))]
        shape[x] = (leaf(x), tuple(s)) if sum(t != "<*>" for t in s) >= FIXED_SHARE * len(s) else x
    held = defaultdict(dict)
    for d, _, x, _, known in places:
        held[shape[x]][known] = min(held[shape[x]].get(known, d), d)
    gone = set()
    for tpl, by in held.items():
        first = min(by, key=by.get)
        if sum(bool(k) and not {*k} & {*first} for k in by) >= min_docs - 1:
            gone.add(tpl)
    out = {}
    for d, t in docs:
        lines = (t or "").split("\n")
        keep = [x for x in lines if shape.get(x) not in gone]
        solid = lambda ls: sum(bool(re.search(SOLID, x)) for x in ls)
        out[d] = (solid(lines), solid(lines) - solid(keep), None if t is None else "\n".join(keep))
    return out


def test_query_against_brute_force(spark):
    sf = SMALL.replace("0.001", "0.01")
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(docs, 10)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in op4_line_dedup(spark, sf).collect()}
    assert got == want
    assert sum(w[1] for w in want.values()) > 300


def test_templates_copies_and_clean_lines(spark):
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMN"
    body = lambda i: "\n".join(" ".join(letters[i] * (j + k + 1) for j in range(5 + k)) for k in range(4))
    docs = []
    for i in range(40):
        a, b = body(i).split("\n")[:2], body(i).split("\n")[2:]
        docs.append("\n".join([*a, f"Posted by user{i} at {i}:30 in the forum", *b, "Share this page now", "This work is licensed", "to you as it is"]))
    story = ["Once upon a time there lived", "a king in a far land", "who had three brave sons", "and a clever little daughter", "the end of this tale"]
    for i in range(30):   # near copies: one line edited in each
        docs.append("\n".join(story[:1 + i % 4] + [f"edited words number {i} go"] + story[2 + i % 4:]))
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in drop_recurring(frame, counted=True).collect()}
    assert got == brute(list(enumerate(docs)), 10)
    for i in range(40):
        assert got[i][2] == body(i), i                  # the templates go, nothing else
    assert all(got[40 + i][1] == 0 for i in range(30))


def test_odd_rows(spark):
    line = "All rights are reserved"
    name = [chr(97 + i) * 3 for i in range(12)]
    rows = [(i, f"start {name[i]} of text\n{line}\n\n \nend {name[i]} is here x", i, 99, "a") for i in range(12)]
    rows += [(None, line, 1, 1, "b"), (50, None, 1, 1, None), (51, "", 0, 0, "c"), (3, rows[3][1], 3, 99, "a"), (52, "word " * 100_000, 1, 500_000, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h int, n_chars long, gone string")
    out = drop_recurring(docs)
    assert out.schema == docs.schema
    got = out.collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[5].text == "start fff of text\n\n \nend fff is here x" and by[5].n_chars == len(by[5].text)
    assert by[50].text is None and by[51].text == "" and by[52].n_chars == 500_000 and by[None].text == ""
    assert sum(r.doc_id == 3 and line not in r.text for r in got) == 2
    assert drop_recurring(docs.filter(F.lit(False))).count() == 0


def test_long_shared_lines_in_otherwise_different_documents(spark):
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMN"
    body = lambda i: "\n".join(" ".join(letters[i] * (j + k + 1) for j in range(5 + k)) for k in range(4))
    shared = ["We use cookies on this site " + "to make it work better " * 9, "This text is licensed to all readers " + "without any warranty " * 9,
              "Copyright of the whole text " + "is with its several authors " * 2, "Share this page now"]
    story = [f"{w} line of a story " + "which is told again " * 3 for w in ("first", "second", "third", "fourth", "fifth", "sixth")]
    for n in (2, 3, 4):
        docs = ["\n".join([shared[0], body(i), *shared[1:n]]) for i in range(40)]
        for i in range(30):   # near copies: a line edited in each, by other words
            docs.append("\n".join(story[:i % 6] + [f"{letters[i] * 3} {letters[i] * 5} {letters[i] * 4} words are new " * 2] + story[i % 6 + 1:]))
        frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
        got = {r.doc_id: (r.n_dropped, r.text) for r in drop_recurring(frame, counted=True).collect()}
        assert all(got[i] == (n, body(i)) for i in range(40)), n
        assert all(got[40 + i] == (0, docs[40 + i]) for i in range(30)), n


def test_lines_are_parsed_from_one_split_and_leaves_from_the_first_tokens(spark):
    """op4's CPU: a text is split once, and no line is split as a whole to know its leaf."""
    from loadkit.llm.common import text_rows
    from loadkit.llm.line_dedup import is_deep, line_rows
    lines = ["a b", "a  b\tc", " a b c ", "a b c d7", "a b7 c d", "a 9b c x", "a <*> c y", "é b c", "x1 22 c3 d", "\x0b \r", "", "7"]
    rows = line_rows(text_rows(spark.createDataFrame([(1, "\n".join(lines)), (2, None), (3, "")], "doc_id long, text string")))
    got = rows.select("line", "plain", "leaf", is_deep(F.col("plain")).alias("deep")).collect()
    plain = {x: " ".join(re.split(r"[\x20\x09-\x0D]+", x.strip("\x20\t\x0b\x0c\r"))) for x in lines}
    assert {r.line: r.plain for r in got} == {k: v for k, v in plain.items() if v}
    known = {r.line: (len(t := r.plain.split(" ")), *("<*>" if re.search("[0-9]", x) else x for x in t[:3])) for r in got}
    assert {r.line: r.deep for r in got} == {k: v[0] >= 3 for k, v in known.items()}
    assert all((a.leaf == b.leaf) == (known[a.line] == known[b.line]) for a in got for b in got)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(text") == 1 and "split(lambda" not in plan, plan
