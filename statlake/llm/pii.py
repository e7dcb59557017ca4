"""Personal data replaced by surrogates, with DataFrame functions only.

*Detection*: one pattern finds e-mail addresses, phone numbers, IPv4 and IPv6
addresses, payment cards, social security numbers, IBANs, secrets (after a
marker such as ``password=`` or ``"api_key": `` in any case, bearer credentials,
signed tokens, access key ids), and names after a title.

*Surrogates*: an entity is one canonical string per type (case, blanks and
punctuation do not count, so all its mentions share it).  Its surrogate comes
from a keyed digest of (type, canonical string, attempt): digits become
digits, letters letters of the same script; a phone keeps its country code, a
card its first digit and a valid check digit, an address the digits per part,
a mail its top-level domain.  Names are made of syllables of their script,
first names with an ending of the title's gender; surname and first name are
entities of their own, so "Mr. Ada Moss" and "Mr. Moss" stay one person.
A mention's surrogate takes over the mention's own case and punctuation.

*Collision checks*: over all distinct entities, a surrogate that another
entity has, or that is itself an entity of the corpus, is drawn again with the
next attempt until all are distinct; later attempts draw from wider spaces.
Only entities that needed another attempt travel back to their documents.

Defined cases: null text stays null and empty text empty; texts without an
entity are returned unchanged; repeated rows are treated alike; ids may be
null or repeated; all other columns pass through ``replace_pii`` untouched,
whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.frames import materialise

MALE, FEMALE, ANY = "Mr|Herr|Señor|Monsieur|Signor|г-н|господин", "Mrs|Ms|Miss|Frau|Señora|Madame|Mme|Signora|г-жа|госпожа", "Dr|Prof"
NAME = r"\p{Lu}[\p{L}'’-]*\p{L}"
MARKER = "(?i:token|secret|password|passwd|api_key|apikey)"
#: Between a marker and its secret: a plural, a closing quote, blanks around = or :, an opening quote.
ASSIGN = r"[sS]?[\"']? {0,4}[=:] {0,4}[\"']?"
IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?"
GROUPS = r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}"   # of an IPv6 address, on a side of its "::"
KINDS = {   # in the order in which they are tried at a place
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "secret": rf"(?<={MARKER}{ASSIGN})[A-Za-z0-9_+/-]{{12,}}+"
              # a bearer's credentials, signed tokens of three parts, access key ids
              r"|(?<=(?i:bearer) )[A-Za-z0-9_+/-]{12,}+(?:\.[A-Za-z0-9_+/-]+)*"
              r"|(?<![\p{L}\p{N}])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"
              r"|(?<![\p{L}\p{N}])A(?:KIA|SIA)[A-Z0-9]{16}(?![\p{L}\p{N}])",
    "iban": rf"(?<![\p{{L}}\p{{N}}]){IBAN}(?![\p{{L}}\p{{N}}])",
    "ipv6": r"(?<![\p{L}\p{N}:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\p{L}\p{N}:])"
            # with "::": at most seven groups around it; an IPv4 tail is left to the next pattern
            r"|(?<![\p{L}\p{N}:])(?=[0-9A-Fa-f:]{0,35}::)(?!(?:[0-9A-Fa-f]*:){9})"
            rf"(?:(?:{GROUPS})?::{GROUPS}|{GROUPS}::)(?![\p{{L}}\p{{N}}]|:[\p{{L}}\p{{N}}:]|\.\d)",
    "ip": r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)",
    "card": r"(?<![\p{L}\p{N}])(?:\d{4} \d{4} \d{4} \d{1,7}|\d{4}-\d{4}-\d{4}-\d{1,7}|\d{13,19})(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}"
             r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\p{L}\p{N}])",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{MALE}|{FEMALE}|{ANY})\.? {NAME}(?: {NAME})?",
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
#: Every entity holds a digit, an @ or a group between colons, or follows a title or marker: most texts stop here.
HINT = rf"[0-9@]|:[A-Fa-f]{{0,4}}:|(?:{MALE}|{FEMALE}|{ANY})\.? \p{{Lu}}|{MARKER}{ASSIGN}|(?i:bearer) |eyJ"

ALPHABETS = {   # script class -> letters that stand in
    r"[a-z]": "abcdefghijklmnopqrstuvwxyz", r"[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    r"\p{IsCyrillic}": "абвгдежзиклмнопрстуфхцчшэюя", r"\p{IsGreek}": "αβγδεζηθικλμνξοπρστυφχψω",
    r"\p{IsHan}": "山川田中大小木林月日水火石金", r"\p{L}": "abcdefghijklmnopqrstuvwxyz",
}
SYLLABLES = {"latin": "bar ben cal dor fen gal hol jas kel lan mor nel pad ral sel tor".split(),
             "cyrillic": "бар вел гор дан жел зор кал лан мир нов пол рад сел тар вол мел".split()}
ENDINGS = {"latin": {"m": "an or ik us".split(), "f": "a ia ina ela".split(), "n": "e in el is".split()},
           "cyrillic": {"m": "ан ор ик ем".split(), "f": "а ия ина ела".split(), "n": "е ин ель им".split()}}
WIDER = 4   # attempts from here on draw from a wider space
MAX_ATTEMPTS = 64


def let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` evaluated once, however often it is used."""
    return F.transform(F.array(value), then)[0]


def _entity(kind: str | Column, canon: Column) -> Column:
    return F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), canon.alias("canon"))


def _digits(mention: Column) -> Column:
    return F.regexp_replace(mention, r"[^0-9]", "")


def _kind(mention: Column) -> Column:
    """Type of a mention, by what it looks like on its own."""
    out = F.lit("secret")
    for kind, test in reversed([
            ("email", "@"), ("name", rf"^(?:{MALE}|{FEMALE}|{ANY})\.? "), ("iban", rf"^{IBAN}$"),
            ("ipv6", r"^(?:[0-9A-Fa-f]{1,4}:){7}|^[0-9A-Fa-f:]*::"), ("ip", r"^\d{1,3}(?:\.\d{1,3}){3}$"),
            ("ssn", r"^\d{3}-\d{2}-\d{4}$"), ("card", r"^\d[\d -]{11,}\d$"), ("phone", r"^[+(\d][\d ().-]*\d$")]):
        out = F.when(mention.rlike(test), F.lit(kind)).otherwise(out)
    return out


def _name_parts(mention: Column) -> tuple[Column, Column, Column]:
    """(gender, first name or null, surname)."""
    bare = F.regexp_replace(mention, rf"^(?:{MALE}|{FEMALE}|{ANY})\.? ", "")
    # longer titles contain shorter ones, so female titles are tried first
    gender = (F.when(mention.rlike(rf"^(?:{FEMALE})\.? "), "f").when(mention.rlike(rf"^(?:{MALE})\.? "), "m")
              .otherwise("n"))
    return gender, F.when(bare.contains(" "), F.substring_index(bare, " ", 1)), F.substring_index(bare, " ", -1)


def _canon(kind: Column, mention: Column) -> Column:
    phone = F.when(mention.startswith("+"), F.concat(
        F.regexp_extract(mention, r"^(\+(?:\d{1,3}(?=[^\d])|\d))", 1), F.lit(" "),
        _digits(F.regexp_replace(mention, r"^\+(?:\d{1,3}(?=[^\d])|\d)", "")))).otherwise(_digits(mention))
    return (F.when(kind == "phone", phone).when(kind.isin("card", "ssn"), _digits(mention))
            .when(kind == "iban", F.replace(mention, F.lit(" ")))
            .when(kind.isin("email", "ipv6"), F.lower(mention)).otherwise(mention))


def entities_of(mention: Column) -> Column:
    """struct<mention, kind, entities array<struct<kind, canon>>>: two entities for a
    full name, else one."""
    def entities(kind: Column) -> Column:
        gender, first, last = _name_parts(mention)
        surname = _entity("surname", F.lower(last))
        return F.struct(mention.alias("mention"), kind.alias("kind"), (
            F.when(kind != "name", F.array(_entity(kind, _canon(kind, mention))))
            .when(first.isNull(), F.array(surname))
            .otherwise(F.array(_entity(F.concat(F.lit("first_"), gender), F.lower(first)), surname))).alias("entities"))
    return let(_kind(mention), entities)


def _number(digest: Column, at: Column | int) -> Column:
    """16 bits of a 64-digit hex digest, by position."""
    at = F.lit(at) if isinstance(at, int) else at
    return F.conv(F.substr(digest, F.pmod(at * 3, F.lit(61)) + 1, F.lit(4)), 16, 10).cast("int")


def _pick(letters: str, number: Column) -> Column:
    return F.substr(F.lit(letters), F.pmod(number, F.lit(len(letters))) + 1, F.lit(1))


def _chars(text: Column, digest: Column, hexadecimal: bool = False) -> Column:
    """Every digit by a digit and every letter by a letter of its script."""
    def one(c: Column, i: Column) -> Column:
        v = _number(digest, i)
        if hexadecimal:
            return F.when(c.rlike("[0-9a-f]"), _pick("0123456789abcdef", v)).otherwise(c)
        out = c
        for test, letters in reversed(ALPHABETS.items()):
            out = F.when(c.rlike(test), _pick(letters, v)).otherwise(out)
        return F.when(c.rlike("[0-9]"), _pick("0123456789", v)).otherwise(out)
    return F.concat_ws("", F.transform(F.split(text, ""), one))


def _check_digit(body: Column) -> Column:
    """The digit that makes ``body`` plus it pass the Luhn check."""
    total = F.aggregate(F.transform(F.split(F.reverse(body), ""), lambda c, i: F.when(
        i % 2 == 0, F.when(c.cast("int") * 2 > 9, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2))
        .otherwise(c.cast("int"))), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10)).cast("string")


def surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """Canonical surrogate of an entity."""
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string")), 256)
    return let(F.struct(kind.alias("kind"), canon.alias("canon"), attempt.alias("attempt"), digest.alias("digest")),
               lambda e: _made(e["kind"], e["canon"], e["attempt"], e["digest"]))


def _made(kind: Column, canon: Column, attempt: Column, digest: Column) -> Column:
    wide = attempt >= WIDER
    extra = F.when(wide, F.substr(digest, F.lit(1), F.least(attempt - WIDER + 2, F.lit(32)))).otherwise("")
    # the top-level domain stays
    mail = F.concat(_chars(F.regexp_extract(canon, r"^([^@]*)@", 1), digest), extra, F.lit("@"),
                    _chars(F.regexp_extract(canon, r"@(.*)\.[^.]*$", 1), F.reverse(digest)), F.lit("."),
                    F.substring_index(canon, ".", -1))
    code = F.regexp_extract(canon, r"^(\+\d+ )", 1)
    rest = F.regexp_replace(canon, r"^\+\d+ ", "")
    phone = F.concat(code, (F.pmod(_number(digest, 0), F.lit(8)) + 2).cast("string"),
                     _chars(F.substr(rest, F.lit(2)), F.reverse(digest)))
    octets = F.concat_ws(".", F.transform(F.split(canon, r"\."), lambda o, i: F.when(
        wide, F.pmod(_number(digest, i), F.lit(254)) + 1).when(F.length(o) == 3, F.pmod(_number(digest, i), F.lit(155)) + 100)
        .when(F.length(o) == 2, F.pmod(_number(digest, i), F.lit(90)) + 10)
        .otherwise(F.pmod(_number(digest, i), F.lit(9)) + 1).cast("string")))
    body = F.concat(F.substr(canon, F.lit(1), F.lit(1)),
                    _chars(F.substr(canon, F.lit(2), F.length(canon) - 2), digest))
    iban = F.concat(F.substr(canon, F.lit(1), F.lit(2)), _chars(F.substr(canon, F.lit(3)), digest))
    secret = (F.when(canon.rlike("^[0-9a-f]+$"), _chars(canon, digest, True))
              .when(canon.rlike("^[0-9A-F]+$"), F.upper(_chars(F.lower(canon), digest, True))).otherwise(_chars(canon, digest)))

    def name(script: str) -> Column:
        s = F.array(*[F.lit(x) for x in SYLLABLES[script]])
        syllable = lambda i: F.element_at(s, F.pmod(_number(digest, i), F.lit(len(SYLLABLES[script]))) + 1)
        end = F.lit("")
        for g, ends in ENDINGS[script].items():
            e = F.array(*[F.lit(x) for x in ends])
            end = F.when(kind == f"first_{g}", F.element_at(e, F.pmod(_number(digest, 5), F.lit(len(ends))) + 1)).otherwise(end)
        more = F.concat_ws("", F.transform(F.sequence(F.lit(6), F.greatest(attempt - WIDER, F.lit(0)) + 7), syllable))
        return F.concat(syllable(0), syllable(1), F.when(kind == "surname", syllable(2)).otherwise(""),
                        F.when(wide, more).otherwise(""), end)

    names = F.when(canon.rlike(r"\p{IsCyrillic}"), name("cyrillic")).otherwise(name("latin"))
    return (F.when(kind == "email", mail).when(kind == "phone", phone).when(kind == "ip", octets)
            .when(kind == "card", F.concat(body, _check_digit(body))).when(kind == "ssn", _chars(canon, digest))
            .when(kind == "ipv6", _chars(canon, digest, True)).when(kind == "iban", iban)
            .when(kind == "secret", secret).otherwise(names))


def _dressed(mention: Column, plain: Column) -> Column:
    """``plain`` in the case and punctuation of ``mention``: letters and digits are
    dealt to the mention's own places; what is left over follows."""
    kept = F.split(F.regexp_replace(plain, r"[^\p{L}\p{N}]", ""), "")
    places = F.split(mention, "")
    step = F.aggregate(places, F.struct(F.lit(0).alias("n"), F.lit("").alias("out")), lambda a, c: F.when(
        c.rlike(r"[\p{L}\p{N}]"), F.struct((a["n"] + 1).alias("n"), F.concat(a["out"], F.coalesce(F.when(
            c.rlike(r"\p{Lu}"), F.upper(F.get(kept, a["n"]))).otherwise(F.get(kept, a["n"])), F.lit(""))).alias("out")))
        .otherwise(F.struct(a["n"].alias("n"), F.concat(a["out"], c).alias("out"))))
    return F.concat(step["out"], F.concat_ws("", F.slice(kept, step["n"] + 1, F.size(kept))))


def _cased(like: Column, plain: Column) -> Column:
    return F.when((F.length(like) > 1) & (F.upper(like) == like), F.upper(plain)).otherwise(F.initcap(plain))


def mention_surrogate(mention: Column, attempts: Column | None, key: str) -> Column:
    """struct<kind, text>: what stands for a mention; ``attempts`` (map of "kind
    canon" to attempt) holds the entities that needed another attempt."""
    def made(e: Column) -> Column:
        tried = F.lit(0) if attempts is None else F.coalesce(
            F.try_element_at(attempts, F.concat_ws(" ", e["kind"], e["canon"])), F.lit(0))
        return surrogate(e["kind"], e["canon"], tried, key)

    def written(x: Column) -> Column:
        mention, kind, made = x["mention"], x["kind"], x["made"]
        _, first, last = _name_parts(mention)
        title = F.regexp_extract(mention, rf"^((?:{MALE}|{FEMALE}|{ANY})\.? )", 1)
        named = F.concat(title, F.when(first.isNull(), "").otherwise(F.concat(_cased(first, made[0]), F.lit(" "))),
                         _cased(last, F.element_at(made, -1)))
        # addresses may change their number of digits and mails grow: they are written as made
        return F.struct(kind.alias("kind"), (
            F.when(kind == "name", named).when(kind.isin("ip", "secret"), made[0])
            .when(kind == "email", F.when(F.upper(mention) == mention, F.upper(made[0])).otherwise(made[0]))
            .otherwise(_dressed(mention, made[0]))).alias("text"))

    return let(let(entities_of(mention), lambda x: F.struct(
        x["mention"], x["kind"], F.transform(x["entities"], made).alias("made"))), written)


def _is(kind: str):
    return lambda x: x == kind


def mentions(text: Column) -> Column:
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(
        F.array().cast("array<string>"))


def attempts_needed(entities: DataFrame, key: str) -> DataFrame | None:
    """Distinct entities (kind, canon) whose first surrogate is taken: kind,
    canon, attempt; None when there are none."""
    every = entities.withColumn("attempt", F.lit(0))
    drawn = materialise(every.withColumn("made", surrogate(F.col("kind"), F.col("canon"), F.col("attempt"), key)),
                        "pii-surrogates")
    real = drawn.select("kind", F.col("canon").alias("made"))
    settled, result, open_ = None, None, drawn
    for attempt in range(MAX_ATTEMPTS):
        # of the entities that share a surrogate the smallest keeps it, if nobody has it already
        owner = open_.groupBy("kind", "made").agg(F.min("canon").alias("owner"), F.count(F.lit(1)).alias("n"))
        taken = real if settled is None else real.unionByName(settled)
        bad = owner.join(taken.withColumn("hit", F.lit(True)).distinct(), ["kind", "made"], "left")
        bad = bad.where("hit OR n > 1").select("kind", "made", F.when(F.col("hit").isNull(), F.col("owner")).alias("owner"))
        lost = open_.join(bad, ["kind", "made"]).where("owner IS NULL OR owner != canon").select("kind", "canon")
        lost = materialise(lost, "pii-collisions")
        if attempt:
            done = open_.join(lost, ["kind", "canon"], "left_anti")
            result = done if result is None else result.unionByName(done)
        won = open_.join(lost, ["kind", "canon"], "left_anti").select("kind", "made")
        settled = won if settled is None else settled.unionByName(won)
        if lost.isEmpty():
            return None if result is None else result.select("kind", "canon", "attempt")
        open_ = materialise(
            lost.withColumn("attempt", F.lit(attempt + 1))
            .withColumn("made", surrogate(F.col("kind"), F.col("canon"), F.col("attempt"), key)), "pii-retries")
    raise ValueError(f"surrogates still collide after {MAX_ATTEMPTS} attempts")


def replace_pii(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text",
                counts: bool = False) -> DataFrame:
    """``docs`` with every mention in ``text_col`` replaced; with ``counts`` only
    doc_id, text, n_entities and n_<kind>."""
    found = docs.select(F.col(id_col).alias("doc_id"), F.explode(mentions(F.col(text_col))).alias("mention"))
    found = materialise(found.select("doc_id", F.inline(entities_of(F.col("mention"))["entities"])).distinct(), "pii-entities")
    retried = attempts_needed(found.select("kind", "canon").distinct(), key)

    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    tried = None
    if retried is not None:
        per_doc = (found.join(retried, ["kind", "canon"]).groupBy("doc_id").agg(F.map_from_entries(F.collect_set(
            F.struct(F.concat_ws(" ", "kind", "canon"), "attempt"))).alias("tried")))
        per_doc = materialise(per_doc, "pii-attempts").withColumnRenamed("doc_id", "tried_id")
        rows = rows.join(per_doc, F.col("doc_id").eqNullSafe(F.col("tried_id")), "left")
        tried = F.col("tried")
    rows = rows.withColumn("made", F.transform(mentions(F.col("text")), lambda m: mention_surrogate(m, tried, key)))
    replaced = F.concat_ws("", F.flatten(F.zip_with(
        F.split("text", PATTERN, -1), F.col("made.text"), lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))))
    rows = rows.withColumn("new", F.when(F.size("made") > 0, replaced).otherwise(F.col("text")))
    if counts:
        return rows.select("doc_id", F.col("new").alias("text"), F.size("made").alias("n_entities"), *[
            F.size(F.array_remove(F.transform("made.kind", _is(k)), False)).alias(f"n_{k}") for k in KINDS])
    return rows.select(*[F.col("new").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
