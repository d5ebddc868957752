"""Operator 1: personal data replaced by surrogates.

Detected entities get replacements that follow from a key: of the same type and format
(digits for digits, letters for letters, check digits right again), names of the same
gender and script. An entity is its canonical form, so all its mentions, in any document
and notation, get one surrogate. Surrogates are checked against each other and against
the real entities of the corpus; those that collide are drawn again, so different entities
stay different. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.shared import stored

#: Titles before names, by the gender they tell; "x": the given name's ending tells it.
TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Srta", "Doña", "Signora", "г-жа", "госпожа", "κυρία"],
    "m": ["Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Don", "Signor", "г-н", "господин", "κύριος"],
    "x": ["Dr", "Prof", "Professor"],
}
#: Syllables that surrogate names are made of, and their endings, by script.
SYLLABLES = {
    "Latin": "ba be bi bo da de di do fa fe ga ge ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro sa se ta te ti to va ve",
    "Cyrillic": "ба бе би бо да де ди до га ге ка ке ки ко ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се та те ти то ва ве",
    "Greek": "βα βε βι βο δα δε δι δο γα γε κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο σα σε τα τε τι το φα φε",
}
ENDINGS = {
    "Latin": {"surname": "son man ner berg field ton", "given_f": "lina nia ra rietta dia", "given_m": "rin tor las mund ric"},
    "Cyrillic": {"surname": "ков нин ский ченко лев", "given_f": "лина ния ра дия са", "given_m": "рин тор лав мир дан"},
    "Greek": {"surname": "δης πουλος κης ρας νος", "given_f": "λινα νια ρα δια σα", "given_m": "ρινος τωρ λας μος δων"},
}

def _titles(genders: str) -> str:
    """A pattern of the titles that tell one of ``genders``, as written or in capitals."""
    found = sorted({v for g in genders for t in TITLES[g] for v in (t, t.upper())}, key=lambda t: (-len(t), t))
    return "|".join(found)


_TITLE = _titles("fmx")
#: One title or more, each with its space, before a name; a name is no title itself.
_RUN = rf"(?:(?:{_TITLE})\.?[ \x{{a0}}])"
_NAME = rf"(?!(?:{_TITLE})['’-]*(?![\p{{L}}'’-]))\p{{Lu}}[\p{{L}}'’-]*\p{{L}}"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
PERSON = rf"(?<!\p{{L}}){_RUN}+(?:{_NAME}[ \x{{a0}}]){{0,2}}{_NAME}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
ADDRESS = rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
SOCIAL = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
CARD = r"(?<![A-Za-z0-9.+])(?:\d[ -]?){12,18}\d(?![A-Za-z0-9])"
PHONE = (r"(?<![\w+.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}"
         r"|\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)")
ALL = "|".join([EMAIL, PERSON, ADDRESS, IBAN, SOCIAL, CARD, PHONE])
#: What any of them contains. The class looked at first turns most places down at once.
_FIRST = "".join(sorted({t[0] for t in _TITLE.split("|")}))
_ANY = rf"(?=[@0-9A-Z{_FIRST}])(?:@|[0-9][0-9 ()+.-]{{4}}|[A-Z]{{2}}[0-9]{{2}}|(?:{_TITLE})\.?[ \x{{a0}}]\p{{Lu}})"


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _type(x: str) -> str:
    """SQL: the type of a mention; a person or a name is "person"."""
    return f"""CASE WHEN contains({x}, '@') THEN 'email' WHEN rlike({x}, '^(?:[A-Z]{{2}}[0-9]{{2}})') THEN 'iban'
        WHEN rlike({x}, '^\\\\p{{L}}') THEN 'person' WHEN rlike({x}, '^[0-9]+([.][0-9]+){{3}}$') THEN 'address'
        WHEN rlike({x}, '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$') THEN 'social'
        WHEN NOT startswith({x}, '+') AND length(regexp_replace({x}, '[^0-9]', '')) >= 13 THEN 'card' ELSE 'phone' END"""


def _words(x: str) -> str:
    """SQL: the name words of a person's mention, without the titles."""
    return f"filter(split({x}, '[ \\\\x{{a0}}]+'), w -> NOT rlike(w, {_sql(rf'^(?:{_TITLE})[.]?$')}))"


def _parts(x: str) -> str:
    """SQL: the entities of a mention as an array of ``struct<type, canonical>``. The last
    name of a person is the surname; a title tells the gender of the given names, or
    else their ending does."""
    female = _sql(rf"^{_RUN}*(?:{_titles('f')})\.?[ \x{{a0}}]")
    male = _sql(rf"^{_RUN}*(?:{_titles('m')})\.?[ \x{{a0}}]")
    gender = f"CASE WHEN rlike({x}, {female}) THEN 'f' WHEN rlike({x}, {male}) THEN 'm' END"
    words = _words(x)
    return f"""CASE {_type(x)}
        WHEN 'person' THEN transform({words}, (w, i) -> struct(CASE WHEN i = size({words}) - 1 THEN 'surname'
            ELSE concat('given_', coalesce({gender}, if(rlike(lower(w), '[aαа]$'), 'f', 'm'))) END AS type, lower(w) AS canonical))
        WHEN 'email' THEN array(struct('email' AS type, lower({x}) AS canonical))
        WHEN 'address' THEN array(struct('address' AS type, {x} AS canonical))
        WHEN 'iban' THEN array(struct('iban' AS type, replace({x}, ' ', '') AS canonical))
        ELSE array(struct({_type(x)} AS type, concat(if(startswith({x}, '+'), '+', ''), regexp_replace({x}, '[^0-9]', '')) AS canonical)) END"""


def _found(text: str) -> Column:
    """The mentions in a text in order; null where the text has none."""
    found = F.regexp_extract_all(text, F.lit(ALL), F.lit(0))
    return F.when(F.rlike(text, F.lit(_ANY)) & (F.size(found) > 0), found)


def mentions(found: DataFrame) -> DataFrame:
    """Adds ``pattern``, ``found`` (all mentions in order) and ``named`` (the distinct name
    entities) to rows whose ``first`` mentions are known.

    A name that is introduced with a title is found again without it in the same text, also in
    capitals."""
    some = found.withColumn("named", F.expr(
        f"array_distinct(flatten(transform(filter(first, x -> {_type('x')} = 'person'), x -> {_parts('x')})))"))
    words = F.expr(f"array_distinct(flatten(transform(filter(first, x -> {_type('x')} = 'person'), x -> {_words('x')})))")
    # as written, in capitals, and with a capital
    words = F.array_distinct(F.flatten(F.transform(words, lambda w: F.array(w, F.upper(w), F.initcap(w)))))
    pattern = F.when(F.size("named") == 0, F.lit(ALL)).otherwise(F.concat(
        F.lit(ALL + r"|(?<!\p{L})(?:"), F.array_join(words, "|"), F.lit(r")(?!\p{L})")))
    return some.withColumn("pattern", pattern).withColumn("found", F.expr(
        "CASE WHEN size(named) = 0 THEN first ELSE regexp_extract_all(text, pattern, 0) END")).drop("first")


def _known(x: str) -> str:
    """SQL: the entities of mention ``x`` where ``named`` are the text's names: a bare
    name is the entity of that name that was introduced."""
    return f"""CASE WHEN {_type(x)} = 'person' AND NOT rlike({x}, {_sql(f'^{_RUN}')})
        THEN slice(filter(named, n -> n.canonical = lower({x})), 1, 1) ELSE {_parts(x)} END"""


def _drawn(key: str) -> dict[str, Column]:
    """The surrogate of ``type, canonical`` at an ``attempt``, from a keyed stream of hex
    digits: characters by class, then what the type fixes."""
    stream = F.sha2(F.concat_ws("\x1f", F.lit(key), "type", "canonical", F.col("attempt").cast("string")), 512)
    number = lambda at, h="h": f"cast(conv(substring({h}, 1 + ({at} * 2) % 126, 2), 16, 10) as int)"

    def drawn(text: str, h: str = "h") -> str:
        return f"""array_join(transform(split({text}, ''), (c, i) -> CASE
            WHEN rlike(c, '[0-9]') THEN cast({number('i', h)} % 10 as string)
            WHEN rlike(c, '[a-z]') THEN char(97 + {number('i', h)} % 26)
            WHEN rlike(c, '[A-Z]') THEN char(65 + {number('i', h)} % 26) ELSE c END), '')"""

    lead = f"cast(1 + {number(50)} % 8 as string)"  # no leading zero
    script = "CASE WHEN rlike(canonical, '\\\\p{IsCyrillic}') THEN 'Cyrillic' WHEN rlike(canonical, '\\\\p{IsGreek}') THEN 'Greek' ELSE 'Latin' END"
    lists = " ".join(f"WHEN '{s}' THEN split('{v}', ' ')" for s, v in SYLLABLES.items())
    ends = " ".join(f"WHEN '{s}{k}' THEN split('{v}', ' ')" for s, by in ENDINGS.items() for k, v in by.items())
    # a name has a syllable more with each attempt, so that names never run out
    stem = f"array_join(transform(sequence(0, 2 + attempt), i -> syllables[{number('if(i < 3, i, i + 1)')} % size(syllables)]), '')"
    body = "substring(canonical, 2, length(canonical) - 2)"
    rest = drawn("substring(canonical, 5)")
    check = (f"cast(98 - aggregate(split(concat({rest}, left(canonical, 2), '00'), ''), 0, (a, c) -> "
             "if(rlike(c, '[0-9]'), (a * 10 + cast(c as int)) % 97, (a * 100 + ascii(c) - 55) % 97)) as string)")
    country = "regexp_extract(canonical, '^([+](?:1|7|2[07]|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})(?=[0-9]{6})|[+]|)', 1)"
    return {
        "h": stream,
        "syllables": F.expr(f"CASE {script} {lists} END"),
        "endings": F.expr(f"CASE concat({script}, type) {ends} END"),
        "surrogate": F.expr(f"""CASE type
            WHEN 'email' THEN concat({drawn("substring_index(canonical, '@', 1)")}, '@', {
                drawn("regexp_replace(substring_index(canonical, '@', -1), '[.][^.]*$', '')", 'hd')},
                '.', substring_index(canonical, '.', -1))
            WHEN 'phone' THEN concat({country}, {lead}, substring({drawn('canonical')}, length({country}) + 2))
            WHEN 'social' THEN concat({lead}, {drawn('substring(canonical, 2)')})
            WHEN 'address' THEN concat_ws('.', cast(1 + {number(0)} % 223 as string), cast({number(1)} as string),
                cast({number(2)} as string), cast(1 + {number(3)} % 254 as string))
            WHEN 'iban' THEN concat(left(canonical, 2), lpad({check}, 2, '0'), {rest})
            WHEN 'card' THEN CASE WHEN luhn_check(canonical) THEN concat(left(canonical, 1), {drawn(body)},
                    cast(filter(sequence(0, 9), d -> luhn_check(concat(left(canonical, 1), {drawn(body)}, cast(d as string))))[0] as string))
                ELSE concat(left(canonical, 1), {drawn('substring(canonical, 2)')}) END
            ELSE concat({stem}, endings[{number(3)} % size(endings)]) END"""),
    }


def surrogates(found: DataFrame, key: str, most_attempts: int = 100) -> DataFrame:
    """``(type, canonical, surrogate)`` of all entities, one to one within a type.

    A surrogate that another entity has, or that is itself an entity of the corpus, is
    drawn again, round by round; of entities with one surrogate the first keeps it."""
    real = stored(found.select("type", "canonical").distinct(), "entities")
    drawn = _drawn(key)

    def draw(rows: DataFrame) -> DataFrame:
        # a domain draws from a stream of its own, so that it keeps one surrogate
        domain = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("domain"), F.substring_index("canonical", "@", -1), F.lit("")), 512)
        return rows.withColumn("h", drawn["h"]).withColumn("hd", domain).withColumns(
            {k: drawn[k] for k in ("syllables", "endings")}).withColumn("surrogate", drawn["surrogate"]).select(
            "type", "canonical", "attempt", "surrogate")

    done, todo = None, draw(real.withColumn("attempt", F.lit(0)))
    for attempt in range(1, most_attempts + 1):
        rows = stored(todo if done is None else done.union(todo), "surrogates")
        first = rows.groupBy("type", "surrogate").agg(F.min(F.struct("attempt", "canonical")).alias("first"))
        taken = real.select("type", F.col("canonical").alias("surrogate"), F.lit(True).alias("real"))
        rows = rows.join(first, ["type", "surrogate"]).join(taken, ["type", "surrogate"], "left").withColumn(
            "ok", F.col("real").isNull() & (F.col("first.canonical") == F.col("canonical")))
        rows = stored(rows.select("type", "canonical", "attempt", "surrogate", "ok"), "checked")
        done, again = rows.where("ok").drop("ok"), rows.where("not ok")
        if again.isEmpty():
            return done.select("type", "canonical", "surrogate")
        todo = draw(again.select("type", "canonical", F.lit(attempt).alias("attempt")))
    raise ValueError(f"no free surrogates after {most_attempts} attempts")


def _rendered(x: str) -> str:
    """SQL: mention ``x`` with its surrogates from ``known``, in the mention's notation:
    digits in the places of digits, capitals where it has them, its titles and spaces."""
    of = lambda t, c: f"element_at(known, concat({t}, ':', {c}))"
    fill = f"""aggregate(split({x}, ''), struct(1 AS at, '' AS out), (a, c) -> if(rlike(c, '[A-Z0-9]'),
        struct(a.at + 1 AS at, concat(a.out, substring(s, a.at, 1)) AS out), struct(a.at AS at, concat(a.out, c) AS out)), a -> a.out)"""
    number = f"concat_ws('', transform(array({of('e.type', 'e.canonical')}), s -> {fill.replace('substring(s,', 'substring(ltrim(%s, s),' % _sql('+'))}))"
    cased = lambda c, s: f"CASE WHEN {c} = upper({c}) AND length({c}) > 1 THEN upper({s}) ELSE initcap({s}) END"
    email = f"array_join(zip_with(split({x}, ''), split({of('e.type', 'e.canonical')}, ''), (c, s) -> if(rlike(c, '[A-Z]'), upper(s), s)), '')"
    name = f"""coalesce({of("'surname'", 'lower(w)')}, {of("'given_f'", 'lower(w)')}, {of("'given_m'", 'lower(w)')})"""
    typed = f"element_at(known, concat(p.type, ':', p.canonical))"
    spaces = f"regexp_extract_all(regexp_replace({x}, {_sql(f'^{_RUN}+')}, ''), '[ \\\\x{{a0}}]', 0)"
    person = f"""CASE WHEN rlike({x}, {_sql(f'^{_RUN}')}) THEN concat(
            regexp_extract({x}, {_sql(f'^({_RUN}+)')}, 1),
            array_join(zip_with(zip_with({_words(x)}, {_parts(x)}, (w, p) -> coalesce({cased('w', typed)}, w)), {spaces},
                (w, space) -> concat(w, coalesce(space, ''))), ''))
        ELSE array_join(transform(array({x}), w -> coalesce({cased('w', name)}, w)), '') END"""
    e = f"{_known(x)}[0]"
    return (f"CASE {_type(x)} WHEN 'person' THEN {person} WHEN 'email' THEN {email} "
            f"WHEN 'address' THEN {of('e.type', 'e.canonical')} ELSE {number} END").replace("e.type", f"({e}).type").replace("e.canonical", f"({e}).canonical")


def with_surrogates(docs: DataFrame, key: str = "surrogates") -> DataFrame:
    """``docs`` with every detected entity in ``text`` replaced, and ``n_entities``.

    Null and empty texts, and those without an entity, are as they were; other columns
    too, but an ``n_entities`` of their own. Repeated rows are answered alike. Only texts
    with an entity are stored and shuffled."""
    names = [c for c in docs.columns if c != "n_entities"]
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), docs["text"].alias("text"),
                       F.xxhash64(docs["doc_id"], docs["text"]).alias("key"), docs["doc_id"].alias("id"))
    found = stored(mentions(rows.withColumn("first", _found("text")).where("first is not null")), "found")
    pairs = found.select("key", "id", F.expr(f"explode(array_distinct(flatten(transform(found, x -> {_known('x')})))) AS e")).select(
        "key", "id", "e.*").distinct()
    pairs = stored(pairs, "mentions")
    drawn = surrogates(pairs, key)
    known = pairs.join(drawn, ["type", "canonical"]).groupBy("key", "id").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat_ws(":", "type", "canonical"), "surrogate"))).alias("known"))
    known = known.withColumnsRenamed({"key": "k", "id": "i"})
    met = found.join(known, (found["key"] == known["k"]) & found["id"].eqNullSafe(known["i"]), "left").withColumn(
        "known", F.coalesce("known", F.expr("cast(map() AS map<string, string>)")))  # a mention without entity stays
    text = F.expr(f"""concat_ws('', flatten(zip_with(split(text, pattern, -1), transform(found, x -> coalesce({_rendered('x')}, x)),
        (piece, s) -> array(piece, coalesce(s, '')))))""")
    changed = met.select("row", text.alias("changed"), F.size("found").cast("long").alias("n"))
    bare = rows.where(_found("text").isNull())
    bare = bare.select("row", F.col("text").alias("changed"), F.lit(0).cast("long").alias("n"))
    return changed.union(bare).select(*[F.col("changed").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in names],
                                      F.col("n").alias("n_entities"))
