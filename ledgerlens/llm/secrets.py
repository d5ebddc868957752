"""Operator 6: secret scan with a trigram inverted index.

From every rule's regular expression follows a Boolean query of trigrams that each match
must contain. An index holds, for each trigram the rules ask for, the documents that
contain it; intersecting postings gives the documents in which a rule can match, and only
those are searched by it. Rules whose expression forces no trigram search every document.
DataFrame functions only.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.shared import stored


def any_case(word: str) -> str:
    """A pattern of ``word`` with its ASCII letters in either case."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isascii() and c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """A match counts if its ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


_NAMES = "|".join(map(any_case, ["password", "passwd", "secret", "token", "api_?key"]))

#: The base rules, in the order in which kinds are listed.
BASE = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", "AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", "[0-9a-f]+", 0, 16),
)
#: Formats of public services' keys.
RULES = (
    *BASE,
    Rule("github", "gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

Query = list[set[frozenset[str]]]  # all of the clauses; a clause: any of its sets; a set: all trigrams
_MOST_STRINGS = 64


def trigram_query(pattern: str) -> Query:
    """The trigrams, of lower-cased text, that any match of ``pattern`` contains.

    Walks the parsed expression with the set of strings that the part since the last
    break can be; a part of unknown strings (a large class, a repetition) is a break. An
    empty query says that nothing is mandatory."""
    clauses: Query = []

    def flush(strings: set[str]) -> set[str]:
        grams = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
        grams = {g for g in grams if not any(o < g for o in grams)}  # the weakest alternatives
        if grams and frozenset() not in grams:
            clauses.append(grams)
        return {""}

    def strings_of(op, arg) -> set[str] | None:
        """The finite strings of a node, or None."""
        if op is sre.LITERAL:
            return {chr(arg).lower()}
        if op is sre.IN and all(o is sre.LITERAL for o, _ in arg):
            return {chr(a).lower() for _, a in arg}
        if op is sre.SUBPATTERN:
            return of_sequence(arg[3])
        if op is sre.BRANCH:
            parts = [of_sequence(p) for p in arg[1]]
            return None if None in parts else set().union(*parts)
        if op is sre.MAX_REPEAT and arg[1] == 1:
            inner = of_sequence(arg[2])
            return None if inner is None else inner | ({""} if arg[0] == 0 else set())
        return None

    def of_sequence(nodes) -> set[str] | None:
        out = {""}
        for op, arg in nodes:
            own = strings_of(op, arg)
            if own is None or len(out) * len(own) > _MOST_STRINGS:
                return None
            out = {a + b for a in out for b in own}
        return out

    def walk(nodes, strings: set[str]) -> set[str]:
        for op, arg in nodes:
            own = strings_of(op, arg)
            if own is not None and len(own) * len(strings) <= _MOST_STRINGS:
                strings = {a + b for a in strings for b in own}
                continue
            strings = flush(strings)
            if op is sre.SUBPATTERN:
                strings = walk(arg[3], strings)
            elif op is sre.MAX_REPEAT and arg[0] > 0:
                flush(walk(arg[2], {""}))
        return strings

    flush(walk(parser.parse(pattern), {""}))
    return clauses


def _key() -> Column:
    """What rows are joined by: the id, or for a null id the text's hash."""
    return F.coalesce("doc_id", F.xxhash64("text"))


def trigram_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings ``(trigram, key)`` of the given trigrams over all whole texts, written to
    the shared folder; a trigram is its place among the given ones."""
    low = F.lower("text")
    met = docs.select(_key().alias("key"), low.alias("low")).select(
        "key", F.explode(F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)]))).alias("trigram"))
    return stored(met.select("trigram", "key"), "trigrams")


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(key, kinds)``: the rules with mandatory trigrams that can match in a document.

    A set of trigrams is contained if all its postings have the key; a clause holds if
    one of its sets does, a query if all its clauses do."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    wanted = sorted({t for q in queries.values() for clause in q for grams in clause for t in grams})
    spark = docs.sparkSession
    place = {t: i for i, t in enumerate(wanted)}
    sets = [(kind, c, s, len(grams), place[t]) for kind, q in queries.items() for c, clause in enumerate(q)
            for s, grams in enumerate(sorted(clause, key=sorted)) for t in sorted(grams)]
    if not sets:
        return spark.sql("SELECT 0L AS key, array('') AS kinds WHERE false")
    values = lambda rows, names: spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, rows))} AS t({names})")
    asked = values(sets, "kind, clause, alternative, needed, trigram")
    clauses = values([(k, len(q)) for k, q in queries.items() if q], "kind, clauses")
    postings = trigram_index(docs, wanted)
    # as many rows as the rules have trigrams: a broadcast of a fixed size
    return postings.join(F.broadcast(asked), "trigram").groupBy("key", "kind", "clause", "alternative", "needed").agg(
        F.countDistinct("trigram").alias("found")).where("found = needed").groupBy("key", "kind").agg(
        F.countDistinct("clause").alias("held")).join(F.broadcast(clauses), "kind").where("held = clauses").groupBy("key").agg(
        F.collect_set("kind").alias("kinds"))


def _spans(rule: Rule, order: int) -> Column:
    """``array<struct<start, kind, end>>`` of a rule's matches in ``text``: between two
    matches lies a piece of the split text, so their lengths give the places."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all("text", pattern, F.lit(0))
    tested = F.regexp_extract_all("text", pattern, F.lit(rule.group)) if rule.group else matches
    zipped = F.arrays_zip(F.split("text", rule.pattern, -1).alias("piece"), matches.alias("match"), tested.alias("tested"))
    span = "array<struct<start:bigint,kind:int,end:bigint>>"
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(span).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["piece"])
        end = (begin + F.coalesce(F.length(x["match"]), F.lit(0))).cast("long")
        own = F.struct(begin.cast("long").alias("start"), F.lit(order).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(F.length(x["tested"]) >= rule.least, F.concat(acc["out"], F.array(own))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(zipped, start, step, lambda acc: acc["out"])


def _search(rule: Rule) -> str:
    """For the test whether a text has a match that counts: a run of one class is long
    enough somewhere if a run of the least length is found."""
    return rule.pattern.replace("[0-9a-f]+", "[0-9a-f]{%d}" % rule.least) if rule.kind == "hex" else rule.pattern


def scanned(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(row, spans)`` for every row of ``docs``: ``row`` is a struct of its columns, as
    they are; ``spans`` has ``start, kind, end`` in code points (end exclusive; kind is
    the rule's place) by start, then kind.

    Null texts count as empty; repeated rows and ties are answered each. Only candidates
    are searched by rules with mandatory trigrams."""
    found = stored(candidates(docs, rules), "candidates")
    forced = {r.kind for r in rules if trigram_query(r.pattern)}
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), _key().alias("key"),
                       F.coalesce("text", F.lit("")).alias("text"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    rows = rows.join(found, "key", "left")
    spans = [F.when(F.coalesce(F.array_contains("kinds", r.kind), F.lit(False)) if r.kind in forced else
                    F.rlike("text", F.lit(_search(r))), _spans(r, i)).otherwise(none) for i, r in enumerate(rules)]
    return rows.select("row", F.array_sort(F.concat(*spans)).alias("spans"))


def _joined(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every row."""
    out = scanned(docs.select("doc_id", "text")).withColumn(
        "base", F.filter("spans", lambda s: s["kind"] < len(BASE)))
    return out.select(
        F.col("row.doc_id").alias("doc_id"),
        *[F.expr(f"cast(size(filter(base, s -> s.kind = {i})) as long)").alias(f"n_{r.kind}") for i, r in enumerate(BASE)],
        F.sha2(_joined(F.col("base"), RULES), 256).alias("base_sha256"), _joined(F.col("spans"), RULES).alias("spans"))


#: What stands for a secret in a redacted text.
MASK = "[SECRET]"


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of a secret replaced by ``MASK``; spans that overlap or
    touch become one. Other columns and texts without secrets are as they were."""
    out = scanned(docs)
    text = F.col("row.text")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        apart = (s["start"] > acc["at"]) | (acc["at"] == 0)
        gap = F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(MASK))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(apart, gap).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("spans", start, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    masked = F.when(F.size("spans") > 0, done).otherwise(text)
    return out.select(*[masked.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _oracle() -> str:
    """The result of ``secret_digests`` in DuckDB, searched without an index."""
    quoted = lambda s: s.replace("'", "''")
    parts = [f"""SELECT doc_id, rid, '{r.kind}' AS kind, {i} AS place, i,
  list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS a,
  length(m[i]) AS n FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT doc_id, rid, regexp_extract_all(t, '{quoted(r.pattern)}', 0) AS m, regexp_extract_all(t, '{quoted(r.pattern)}', {r.group}) AS g,
      string_split_regex(t, '{quoted(r.pattern)}') AS p FROM d)) WHERE length(g[i]) >= {r.least}""" for i, r in enumerate(RULES)]
    span = "kind || ':' || a || ':' || (a + n)"
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    return f"""WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join(parts)})
SELECT d.doc_id, {", ".join(f"coalesce(x.n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)},
  sha256(coalesce(x.b, '')) AS base_sha256, coalesce(x.spans, '') AS spans
FROM d LEFT JOIN (SELECT rid, {counts}, string_agg({span}, ',' ORDER BY a, place) FILTER (place < {len(BASE)}) AS b,
  string_agg({span}, ',' ORDER BY a, place) AS spans FROM s GROUP BY rid) x USING (rid)"""


ORACLE_SQL = _oracle()
