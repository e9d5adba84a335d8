"""Secret scan through a trigram inverted index, in DataFrame and SQL functions only.

Each rule is a regular expression.  A Boolean trigram query is derived from
it (an OR of ANDs of trigrams that any match must contain).  The index holds a
posting (trigram, document) for every trigram that some query names; postings
are intersected per branch of a query, and in one scan of the documents each is
read by the expressions of the rules that are left for it.  A rule without
mandatory trigrams reads every document.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from govlens.llm.common import held, released, row_key, table, written


@dataclass(frozen=True)
class Rule:
    """``group`` of a match needs ``min_chars`` characters, or the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    min_chars: int = 1
    base: bool = True


#: The base kinds in their listed order, then those that this scan adds.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),   # runs are maximal, so the length can stand in the pattern
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}", base=False),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", base=False),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}", base=False),
)

MAX_STRINGS = 64


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """An OR of ANDs of lower-case trigrams that each match contains; [] if nothing is mandatory.

    Strings that a stretch of the expression can spell out are multiplied up
    to ``MAX_STRINGS``; a part that can't be spelled out ends the stretch.
    Dropping a condition only makes the query weaker, never wrong.
    """
    branches: list[frozenset[str]] = [frozenset()]

    def grams(s: str) -> frozenset[str]:
        return frozenset(s[i:i + 3] for i in range(len(s) - 2))

    def flush(strings: set[str]) -> None:
        nonlocal branches
        sets = {grams(s) for s in strings}
        if frozenset() in sets:
            return
        merged = {a | b for a in branches for b in sets}
        branches = [a for a in merged if not any(b < a for b in merged)]

    def spell(item) -> set[str] | None:
        """All strings of one element, in lower case, or None."""
        op, arg = str(item[0]), item[1]
        if op == "LITERAL":
            return {chr(arg).lower()}
        if op == "IN" and all(str(o) in ("LITERAL", "RANGE") for o, _ in arg):
            chars = set()
            for o, v in arg:
                low, high = (v, v) if str(o) == "LITERAL" else v
                if high - low > MAX_STRINGS:
                    return None
                chars |= {chr(x).lower() for x in range(low, high + 1)}
            return chars
        if op == "SUBPATTERN":
            return spell_all(arg[-1])
        if op == "BRANCH":
            each = [spell_all(x) for x in arg[1]]
            return None if None in each else set().union(*each)
        if op == "MAX_REPEAT" and arg[1] == 1:
            one = spell_all(arg[2])
            return None if one is None else one | ({""} if arg[0] == 0 else set())
        return None

    def spell_all(items) -> set[str] | None:
        out = {""}
        for x in items:
            s = spell(x)
            if s is None or len(out) * len(s) > MAX_STRINGS:
                return None
            out = {a + b for a in out for b in s}
        return out

    current = {""}
    for item in re._parser.parse(pattern):
        s = spell(item)
        if s is not None and len(current) * len(s) <= MAX_STRINGS:
            current = {a + b for a in current for b in s}
        else:
            flush(current)
            current = s if s is not None and len(s) <= MAX_STRINGS else {""}
    flush(current)
    return [] if frozenset() in branches else sorted(branches, key=sorted)


def trigram_index(docs: DataFrame, text_col: str, trigrams: list[str]) -> DataFrame:
    """The postings (_gram, _k1, _k2) of ``trigrams`` over ``docs``, which has the row key."""
    low = docs.select("_k1", "_k2", F.lower(text_col).alias("_low"))
    found = F.array(*[F.when(F.contains("_low", F.lit(g)), F.lit(g)) for g in trigrams])
    return low.select("_k1", "_k2", F.explode(F.array_compact(found)).alias("_gram"))


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """Documents (_k1, _k2) and the kinds whose trigram query their postings satisfy.

    The query table has a row per (kind, branch, trigram): a constant of the
    rules, not of the data.
    """
    rows = [(kind, i, g, len(grams)) for kind, branches in queries.items()
            for i, grams in enumerate(branches) for g in sorted(grams)]
    terms = index.sparkSession.createDataFrame(rows, "_kind string, _branch int, _gram string, _need int")
    return index.distinct().join(F.broadcast(terms), "_gram") \
        .groupBy("_k1", "_k2", "_kind", "_branch", "_need").agg(F.count(F.lit(1)).alias("_n")) \
        .where("_n = _need").groupBy("_k1", "_k2").agg(F.collect_set("_kind").alias("_kinds"))


def _matches(docs: DataFrame, text_col: str, rules: tuple[Rule, ...], reads: list[Column]) -> DataFrame:
    """A row per match of any rule: its rule and number, the length of the gap before it, its own length, and if it counts.

    One scan: rule i looks at the rows for which ``reads[i]`` holds.
    """
    text = F.col(text_col)
    none = F.array().cast("array<string>")
    found = [F.when(on, F.regexp_extract_all(text, F.lit(r.pattern), F.lit(0))).otherwise(none).alias(f"_all{i}")
             for i, (r, on) in enumerate(zip(rules, reads, strict=True))]
    hit = docs.select("_k1", "_k2", text, *found).where(reduce(lambda a, b: a | b, [F.size(f"_all{i}") > 0 for i in range(len(rules))]))
    size = lambda a: F.transform(a, F.char_length)

    def own(i: int, rule: Rule) -> Column:
        matched = F.col(f"_all{i}")
        group = matched if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
        # the gaps between matches are what split() leaves
        gaps = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(matched))
        parts = F.arrays_zip(size(gaps).alias("gap"), size(matched).alias("len"),
                             F.transform(size(group), lambda n: n >= rule.min_chars).alias("ok"))
        return F.struct(F.lit(i).alias("order"), F.when(F.size(matched) > 0, parts).alias("m"))

    return hit.select("_k1", "_k2", F.array(*[own(i, r) for i, r in enumerate(rules)]).alias("_of")) \
        .dropDuplicates(["_k1", "_k2"]).select("_k1", "_k2", F.explode("_of").alias("_r")) \
        .select("_k1", "_k2", F.col("_r.order").alias("_order"), F.posexplode("_r.m").alias("_i", "_m")) \
        .select("_k1", "_k2", "_order", F.element_at(F.lit([r.kind for r in rules]), F.col("_order") + 1).alias("_kind"), "_i",
                F.col("_m.gap").cast("long").alias("_gap"), F.col("_m.len").cast("long").alias("_len"), F.col("_m.ok").alias("_ok"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Spans of secrets in whole texts: ``docs`` plus ``_spans``, an array of (start, order, kind, end, base).

    Matches of a rule are leftmost and don't overlap; those of different rules
    may.  Offsets count code points, ends are exclusive, spans are sorted by
    start and then by the rules' order.  A null or empty text has no spans (an
    empty array); a repeated row gets its spans each time; an empty table
    gives an empty table.  Texts of any length are read whole.
    """
    src = held(docs, _id=id_col, _text=text_col).select("*", *row_key("_id", "_text"))
    texts = src.select("_k1", "_k2", "_text").where(F.col("_text") != "")
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    read = texts.withColumn("_kinds", F.lit(None).cast("array<string>"))
    if queries:
        grams = sorted({g for q in queries.values() for b in q for g in b})
        # written, so that the planner sees its size: small enough it is broadcast, else both sides are shuffled
        found = written(candidates(trigram_index(texts, "_text", grams), queries), "secret-candidates")
        read = texts.join(found, ["_k1", "_k2"], "left")
    reads = [F.coalesce(F.array_contains("_kinds", r.kind), F.lit(False)) if r.kind in queries else F.lit(True) for r in rules]
    matches = _matches(read, "_text", rules, reads)
    w = Window.partitionBy("_k1", "_k2", "_order").orderBy("_i")
    start = F.sum("_gap").over(w) + F.sum("_len").over(w) - F.col("_len")
    bases = [r.kind for r in rules if r.base]
    spans = matches.withColumn("_start", start).where("_ok") \
        .groupBy("_k1", "_k2").agg(F.sort_array(F.collect_list(F.struct(
            F.col("_start").alias("start"), F.col("_order").alias("order"), F.col("_kind").alias("kind"),
            (F.col("_start") + F.col("_len")).alias("end"), F.col("_kind").isin(bases).alias("base")))).alias("_spans"))
    none = F.from_json(F.lit("[]"), spans.schema["_spans"].dataType)
    out = src.select("_row", "_k1", "_k2").join(spans, ["_k1", "_k2"], "left")
    return out.select(*released(docs.columns, _spans=F.coalesce("_spans", none)))


def op8(spark, sf_dir: str) -> DataFrame:
    out = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "_spans")
    count = lambda kind: F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long")
    joined = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return out.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                      count("hex").alias("n_hex"),
                      F.sha2(joined(F.filter("_spans", lambda s: s["base"])), 256).alias("base_sha256"),
                      joined(F.col("_spans")).alias("spans"))


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """Every rule over every text, without an index, in DuckDB."""
    one = """SELECT doc_id, {o} AS o, '{kind}' AS kind, i, p, l, g >= {n} AS ok, {base} AS base FROM (
      SELECT doc_id, unnest(range(len(m))) AS i, unnest(list_transform(string_split_regex(text, '{rx}')[:len(m)], lambda x: length(x))) AS p,
             unnest(list_transform(m, lambda x: length(x))) AS l, unnest(list_transform(g, lambda x: length(x))) AS g
      FROM (SELECT doc_id, text, regexp_extract_all(text, '{rx}') AS m, regexp_extract_all(text, '{rx}', {g}) AS g
            FROM documents WHERE text IS NOT NULL))"""
    parts = []
    for o, r in enumerate(rules):
        # letters of either case as plain classes
        rx = re.sub(r"\(\?i:([a-z_?|]+)\)", lambda m: re.sub("[a-z]", lambda c: f"[{c[0].upper()}{c[0]}]", m[1]), r.pattern)
        parts.append(one.format(o=o, kind=r.kind, rx=rx.replace("'", "''"), g=r.group, n=r.min_chars, base=str(r.base).lower()))
    return "WITH a AS (" + "\nUNION ALL ".join(parts) + """),
b AS (SELECT *, sum(p) OVER w + sum(l) OVER w - l AS s FROM a WINDOW w AS (PARTITION BY doc_id, o ORDER BY i)),
c AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
        count(*) FILTER (WHERE kind = 'hex') AS n_hex,
        string_agg(concat_ws(':', kind, s::BIGINT, (s + l)::BIGINT), ',' ORDER BY s, o) FILTER (WHERE base) AS bases,
        string_agg(concat_ws(':', kind, s::BIGINT, (s + l)::BIGINT), ',' ORDER BY s, o) AS spans
      FROM b WHERE ok GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(bases, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN c ON d.doc_id = c.doc_id"""
