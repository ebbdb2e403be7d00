"""Personal data and what reveals it: information-theoretic sanitisation (operator 8).

DataFrame functions only. Base spans come from patterns, leftmost and without
overlap per kind; the text between matches gives their code-point offsets. The
patterns are those of the contract, written so that no character is tried twice: a
match begins where a run of its characters begins, or where the last match ended,
and runs never give characters back.

A base span's value is a protected entity. The words up to ``NEAR_CHARS`` characters from
it, on its line and those around it, as far as the next entity of its kind, are its terms.
From the whole corpus, copies of a text counted once: n(e), the texts that hold an
entity; n(t, e), those that have the term beside it; n(t), those that hold the term. A
term's disclosure of the entity is their pointwise mutual information over the entity's
information, log(p(e|t) N / n(e)) / log(N / n(e)): 1 if the term is met only beside the
entity, 0 if the two are independent. p(e|t) is smoothed, (n(t,e) + ``SMOOTH`` n(e)/N) /
(n(t) + ``SMOOTH``), so a term met once tells a little less than one met often, always
beside the entity. Terms are generalised from ``GENERALISE`` on and removed from
``REMOVE`` on, wherever they stand in a document that holds the entity.

Positions in a text are running sums over its matches, taken in chunks, so that the work
is linear in the matches; what stands around a match comes from the pieces between them.

Defined results: NULL and empty texts have no span; rows with equal text get the same
spans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadkit.llm.common import cut, table

KINDS = ("email", "ip", "card", "phone")
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: what beside an entity is another one, and so no term (a card only if it has the digits)
BLANK = "|".join([PATTERNS["email"], PATTERNS["ip"], r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,}+", PATTERNS["phone"]])
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
WORD = r"(?<![\p{L}\p{N}])[\p{L}\p{N}]{3,}"
NEAR_CHARS = 160            # context taken on each side of an entity
SMOOTH = 0.5
GENERALISE, REMOVE = 0.8, 0.95
CHUNK = 64                  # matches added up together


def holds(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return m.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        digits = F.translate(m, " -", "")
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    return F.length(F.regexp_replace(m, "[^0-9]", "")).between(9, 15)


def may_match(kind: str, text: Column) -> Column:
    return {"email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
            "phone": F.contains(text, F.lit("+"))}[kind]


def located(rows: DataFrame, text: str, found: dict[str, tuple[Column, Column]], keep=None) -> DataFrame:
    """``rows`` with an array of ``s, e, m, l, r`` for each entry ``name: (matches, pattern)``
    of ``found``: where a match begins and ends, itself, and what stands to its left and
    right as far as ``NEAR_CHARS`` and the next match. ``keep(name, match)`` chooses."""
    keep = keep or (lambda name, m: F.lit(True))
    t, near, own = F.col(text), F.lit(NEAR_CHARS), rows.columns
    rows = rows.select("*", *[m.alias(f"_m_{k}") for k, (m, _) in found.items()])
    pieces = [F.when(F.size(f"_m_{k}") > 0, F.split(t, p, -1)).otherwise(F.array().cast("array<string>")).alias(f"_b_{k}") for k, (_, p) in found.items()]
    rows = rows.select("*", *pieces)
    # the length of a match and of the piece before it; sums of whole chunks; running sums of these
    size = lambda k: F.transform(f"_m_{k}", lambda m, i: F.length(F.get(f"_b_{k}", i)) + F.length(m))
    rows = rows.select("*", *[size(k).alias(f"_n_{k}") for k in found])
    total = lambda k, c, n: F.aggregate(F.slice(f"_n_{k}", c * CHUNK + 1, n), F.lit(0), lambda acc, x: acc + x)
    chunks = lambda k: F.sequence(F.lit(0), F.floor(F.size(f"_m_{k}") / CHUNK).cast("int"))
    rows = rows.select("*", *[F.transform(chunks(k), lambda c: total(k, c, F.lit(CHUNK))).alias(f"_s_{k}") for k in found])
    running = lambda k: F.aggregate(f"_s_{k}", F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    rows = rows.select("*", *[running(k).alias(f"_o_{k}") for k in found])

    def place(k: str) -> Column:
        def one(m, i):
            c = F.floor(i / CHUNK).cast("int")
            begin = F.get(f"_o_{k}", c) + total(k, c, i % CHUNK) + F.length(F.get(f"_b_{k}", i))
            left, right = F.get(f"_b_{k}", i), F.get(f"_b_{k}", i + 1)
            return F.struct(begin.alias("s"), (begin + F.length(m)).alias("e"), m.alias("m"),
                            F.substring(left, F.greatest(F.lit(1), F.length(left) - near + 1), near).alias("l"), F.substring(right, F.lit(1), near).alias("r"))
        return F.filter(F.transform(f"_m_{k}", one), lambda x: keep(k, x["m"]))
    return rows.select(*own, *[place(k).alias(k) for k in found])


def told(spans: Column, label: str) -> Column:
    """``label:start:end`` of located matches."""
    return F.transform(spans, lambda x: F.concat(F.lit(label + ":"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string")))


def base_matches(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with the located matches of each kind that hold, of a text column without NULL."""
    t, none = F.col(text), F.array().cast("array<string>")
    return located(rows, text, {k: (F.when(may_match(k, t), F.regexp_extract_all(t, F.lit(PATTERNS[k]), F.lit(0))).otherwise(none), F.lit(PATTERNS[k]))
                                for k in KINDS}, holds)


def base_spans(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with an array column of spans per kind."""
    found = base_matches(rows, text)
    return found.select(*rows.columns, *[told(F.col(k), k).alias(k) for k in KINDS])


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def distinct_texts(rows: DataFrame) -> DataFrame:
    """One row per text (copies are left out on the map side already)."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy("th").orderBy("th"))).filter("_n = 1").select("th", "text")


def entity_terms(found: DataFrame) -> DataFrame:
    """``th, entity, term`` of the located base spans: its value in lower case, and each
    word near it (none: a NULL term). Other entities near it are no terms."""
    each = found.select("th", F.explode(F.concat(*KINDS)).alias("x")).select("th", F.lower("x.m").alias("entity"), "x.l", "x.r")
    words = lambda c: F.regexp_extract_all(F.lower(F.regexp_replace(c, BLANK, "\n")), F.lit(WORD), F.lit(0))
    return each.select("th", "entity", F.explode_outer(F.array_distinct(F.concat(words(F.col("l")), words(F.col("r"))))).alias("term")).distinct()


def disclosing_terms(texts: DataFrame, near: DataFrame, generalise: float = GENERALISE) -> DataFrame:
    """``entity, term, disclosure`` of the pairs over the threshold, from all texts."""
    n_e = near.select("th", "entity").distinct().groupBy("entity").agg(F.count("*").alias("n_e"))
    n_te = near.filter(F.col("term").isNotNull()).groupBy("entity", "term").agg(F.count("*").alias("n_te"))
    words = texts.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))).alias("term"))
    n_t = words.groupBy("term").agg(F.count("*").alias("n_t")).join(n_te.select("term").distinct(), "term", "left_semi")   # a row a term
    n = F.lit(float(max(texts.select("th").count(), 2)))
    p_e = F.col("n_e") / F.greatest(n, F.col("n_e") + 1.0)
    p_te = (F.col("n_te") + SMOOTH * p_e) / (F.greatest("n_t", "n_te") + SMOOTH)
    scored = n_te.join(n_e, "entity").join(n_t, "term").select("entity", "term", (F.log(p_te / p_e) / -F.log(p_e)).alias("disclosure"))
    return scored.filter(F.col("disclosure") >= generalise)


def private_spans(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> tuple[DataFrame, DataFrame]:
    """The rows ``doc_id, th, text`` and, by text hash, spans ``kind:start:end`` of every base
    kind, of terms to generalise (``term``) and of terms to remove (``term_removed``)."""
    rows = _rows(docs)
    texts = distinct_texts(rows)
    # a filter on located spans would be pushed below them and find them again: on the written table
    likely = reduce(lambda a, b: a | b, [may_match(k, F.col("text")) for k in KINDS])
    marked = cut(base_matches(texts.filter(likely)), "pii-texts").filter(F.size(F.concat(*KINDS)) > 0)
    near = cut(entity_terms(marked), "pii-terms")
    pairs = disclosing_terms(texts, near, generalise)
    own = near.select("th", "entity").distinct().join(pairs, "entity").groupBy("th", "term").agg(F.max("disclosure").alias("d"))
    words = cut(located(marked.select("th", "text"), "text", {"w": (F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(WORD))})
                .select("th", F.transform("w", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lower(x["m"]).alias("m"))).alias("w")), "pii-words")
    places = words.select("th", F.explode("w").alias("w"))
    hits = places.select("th", "w.s", "w.e", F.col("w.m").alias("term")).join(own, ["th", "term"])
    span = F.struct("s", "e")
    of = hits.groupBy("th").agg(*[F.sort_array(F.collect_list(F.when(c, span))).alias(k)
                                  for k, c in (("term", F.col("d") < remove), ("term_removed", F.col("d") >= remove))])
    base = marked.select("th", *[told(F.col(k), k).alias(k) for k in KINDS])
    none = F.array().cast("array<string>")
    out = base.join(of, "th", "left").select("th", *KINDS, *[F.coalesce(told(F.col(k), k), none).alias(k) for k in ("term", "term_removed")])
    return rows, cut(out, "pii-spans")


def find_private(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, with_text: bool = True) -> DataFrame:
    """Every row (``doc_id, th`` and perhaps ``text``) with an array of spans per base kind and
    of disclosing terms, as ``kind:start:end``."""
    rows, spans = private_spans(docs, generalise, remove)
    none = F.array().cast("array<string>")
    kept = rows if with_text else rows.drop("text")
    return kept.join(spans, "th", "left").select("doc_id", "th", *(["text"] if with_text else []),
                                                 *[F.coalesce(k, none).alias(k) for k in (*KINDS, "term", "term_removed")])


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, sanitised`` of every row: spans replaced by their kind in brackets,
    removed terms by nothing; where spans overlap, the one that begins first stands,
    the longer one of two that begin together. The text is cut up ``CHUNK`` spans at a
    time, so that no step looks at all of it again."""
    found = find_private(docs, **options)
    part = lambda s, i: F.split(s, ":")[i]
    cuts = F.array_sort(F.transform(F.concat(*KINDS, "term", "term_removed"), lambda s: F.struct(
        part(s, 1).cast("int").alias("s"), (-part(s, 2).cast("int")).alias("e"), part(s, 0).alias("k"))))
    found = found.select("doc_id", "text", cuts.alias("_cuts"))
    numbers = F.when(F.size("_cuts") > 0, F.sequence(F.lit(0), F.floor((F.size("_cuts") - 1) / CHUNK).cast("int"))).otherwise(F.array().cast("array<int>"))
    chunks = F.transform(numbers, lambda c: F.slice("_cuts", c * CHUNK + 1, F.lit(CHUNK)))

    def chunk_step(acc, chunk):
        last = F.greatest(acc["at"], F.array_max(F.transform(chunk, lambda x: -x["e"])))
        own = F.substring(F.col("text"), acc["at"] + 1, last - acc["at"])

        def inside(own):       # the chunk's piece of the text, taken once
            def step(a, x):
                mark = F.when(x["k"] == "term_removed", F.lit("")).otherwise(F.concat(F.lit("["), F.upper(x["k"]), F.lit("]")))
                done = F.struct((-x["e"]).alias("at"), F.concat(a["out"], F.substring(own, a["at"] - acc["at"] + 1, x["s"] - a["at"]), mark).alias("out"))
                return F.when(x["s"] >= a["at"], done).otherwise(a)
            return F.aggregate(chunk, F.struct(acc["at"].alias("at"), F.lit("").alias("out")), step)
        one = F.transform(F.array(own), inside)
        return F.transform(one, lambda o: F.struct(o["at"].alias("at"), F.concat(acc["out"], F.array(o["out"])).alias("out")))[0]
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    text = F.aggregate(chunks, start, chunk_step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    return found.select("doc_id", text.alias("sanitised"))


def op8_information_sanitiser(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_private(table(spark, sf_dir, "documents"), with_text=False)
    base = F.array_join(F.concat(*KINDS), ",")
    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(base, 256).alias("base_sha256"),
                        F.array_join(F.concat(*KINDS, "term", "term_removed"), ",").alias("spans"),
                        (F.size("term") + F.size("term_removed")).cast("long").alias("n_term"))
