"""Personal data: regular expressions propose spans, checksums confirm them, context adjusts the score.

The base kinds (email, ip, card, phone) stand by their form alone and always
stay. The method adds kinds whose form is weaker: IBANs, which the mod-97 check
confirms, and national phone numbers, social security numbers and secrets
(tokens, keys, passwords), which need a context word close to them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.text import let

# Forms of the base kinds. Possessive quantifiers stand where no way
# back could match, so that long runs need neither quadratic time nor deep stacks;
# \G lets a match begin inside a run where the one before it ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Forms of the added kinds, and the words that speak for them.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_form() -> str:
    """A form for each length, so that a match ends where its country's numbers do; any length for countries without one."""
    known = "|".join(c for names in IBAN_LENGTHS.values() for c in names.split())
    own = [rf"(?:{'|'.join(names.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, names in IBAN_LENGTHS.items()]
    other = rf"(?!{known})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join([*own, other])})(?![A-Za-z0-9])"


IBAN = _iban_form()
LOCAL_PHONE = r"(?<![A-Za-z0-9+.(-])\(?[0-9]{3,5}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9.-])"
SSN = r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])"
#: Letters and digits mixed, as generated tokens and keys have them.
SECRET = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{20,128}+(?![A-Za-z0-9+/_-])"
PHONE_WORDS = r"(?i)(?<![\p{L}\p{N}])(?:phone|tel|telephone|telefon|téléphone|teléfono|call|mobile|fax)(?![\p{L}\p{N}])"
SSN_WORDS = r"(?i)(?<![\p{L}\p{N}])(?:ssn|social security)(?![\p{L}\p{N}])"
SECRET_WORDS = r"(?i)(?<![\p{L}\p{N}])(?:token|secret|password|passwd|pwd|bearer|credentials?|(?:api|access|private|secret|auth)[_ -]?(?:key|token)|key)(?![\p{L}\p{N}])"

#: Kinds in the order in which spans with one start are listed.
KINDS = ("email", "ip", "card", "phone", "iban", "local_phone", "ssn", "secret")
BASE = KINDS[:4]
#: Characters before and after a span in which a context word counts.
NEAR = 32
THRESHOLD = 0.6
#: Matches or spans that are gone through as one stretch, so that time grows with their number and not with its square.
STRETCH = 256

SPAN = "array<struct<start:int,ord:int,end:int,kind:string,score:double>>"


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn's check: from the right, every second digit doubled, less 9 where above 9; the sum is a multiple of 10."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(c == "", 0).otherwise(_doubled(F.ascii(c) - 48, i)))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def _doubled(v: Column, i: Column) -> Column:
    return F.when(i % 2 == 0, v).when(v * 2 > 9, v * 2 - 9).otherwise(v * 2)


def _mod97(iban: Column) -> Column:
    """ISO 7064: the first four characters at the end, letters as 10 to 35, the number leaves 1."""
    plain = F.replace(iban, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 100), F.substring(plain, 1, 4))

    def step(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(c == "", acc).when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _ip_parts(s: Column) -> Column:
    """Every part is 255 at most; leading zeros don't count."""

    def fits(p: Column) -> Column:
        q = F.regexp_replace(p, "^0+", "")
        return (F.length(q) < 3) | ((F.length(q) == 3) & (q <= "255"))

    return F.forall(F.split(s, r"\.", -1), fits)


def _located(text: Column, kind: str, form: str, hint: Column, score: Callable[[Column, Column], Column], context: bool = False) -> Column:
    """Spans of one kind: leftmost matches that don't overlap, in code points, with a score of THRESHOLD or more.

    The pieces between matches and the matches themselves give every start.
    hint is a cheap test that every text with a match passes. With context,
    score also gets the NEAR characters before and after the span, one array;
    where the text goes on, they end in the character that follows and an x, so
    that a word that is cut there is none.
    """
    edge = NEAR + 1

    def place(pair: Column) -> Column:
        gaps, matches = pair["gaps"], pair["matches"]

        def cut(near: Column, from_left: bool) -> Column:
            part = (F.left if from_left else F.right)(near, F.lit(edge))
            return F.when(F.length(part) < edge, part).otherwise(F.concat(part, F.lit("x")) if from_left else F.concat(F.lit("x"), part))

        def piece(m: Column, i: Column) -> Column:
            gap = F.get(gaps, i)
            fields = [F.length(gap).alias("g"), F.length(m).alias("m"), m.alias("s")]
            if context:  # a match has ten characters at least, so four on each side are enough
                text_of = lambda parts: F.concat(*[F.coalesce(p, F.lit("")) for p in parts])
                before = text_of([p for k in range(4, 0, -1) for p in (F.get(gaps, i - k), F.get(matches, i - k))] + [gap])
                after = text_of([p for k in range(1, 5) for p in (F.get(gaps, i + k), F.get(matches, i + k))])
                fields.append(F.array(cut(before, False), cut(after, True)).alias("near"))
            return F.struct(*fields)

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["g"]
            end = start + x["m"]
            s = score(x["s"], x["near"] if context else F.array().cast("array<string>"))
            one = F.array(F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("ord"), end.alias("end"), F.lit(kind).alias("kind"), s.alias("score"))).cast(SPAN)
            return F.struct(end.alias("at"), F.when(s >= THRESHOLD, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

        def spans_of(stretches: Column, begins: Column) -> Column:
            begin = lambda b: F.struct(F.get(begins, b).alias("at"), F.array().cast(SPAN).alias("out"))
            return F.flatten(F.transform(stretches, lambda p, b: F.aggregate(p, begin(b), step, lambda acc: acc["out"])))

        def from_begins(stretches: Column) -> Column:
            sums = F.transform(stretches, lambda p: F.aggregate(p, F.lit(0), lambda a, x: a + x["g"] + x["m"]))
            begins = F.aggregate(sums, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
            return let(begins, lambda at: spans_of(stretches, at))

        return let(F.transform(matches, piece), lambda lengths: let(_stretches(lengths), from_begins))

    pair = F.struct(F.split(text, form, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(form), F.lit(0)).alias("matches"))
    found = hint & F.rlike(text, F.lit(form))
    return F.when(found, let(pair, place)).otherwise(F.array().cast(SPAN))


def _stretches(array: Column) -> Column:
    """The array in arrays of STRETCH elements; none for an empty one."""
    n = F.ceil(F.size(array) / STRETCH).cast("int")
    return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), lambda b: F.slice(array, b * STRETCH + 1, STRETCH))


def _free(added: Column, base: Column) -> Column:
    """The added spans that overlap no base span; base spans are looked at by stretches that reach to the added one."""

    def keep(bounds: Column) -> Column:
        over = lambda x, y: (x["start"] < y["end"]) & (y["start"] < x["end"])
        return F.filter(added, lambda x: ~F.exists(bounds, lambda b: over(x, b) & F.exists(b["spans"], lambda y: over(x, y))))

    bounds = F.transform(
        _stretches(F.sort_array(base)),
        lambda p: F.struct(F.get(p, F.lit(0))["start"].alias("start"), F.array_max(F.transform(p, lambda y: y["end"])).alias("end"), p.alias("spans")),
    )
    return F.when(F.size(added) > 0, let(bounds, keep)).otherwise(added)


def _yes(condition: Column) -> Column:
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def spans(text: Column) -> dict[str, Column]:
    """The confirmed spans of each kind. text must not be null."""
    n = F.length
    has = lambda c: F.contains(text, F.lit(c))
    digit = F.rlike(text, F.lit("[0-9]"))
    near = lambda around, form, base: F.lit(base) + F.when(F.exists(around, lambda x: F.rlike(x, F.lit(form))), 0.4).otherwise(0.0)
    return {
        "email": _located(text, "email", EMAIL, has("@"), lambda m, b: F.lit(1.0)),
        "ip": _located(text, "ip", IP, digit & has("."), lambda m, b: _yes(_ip_parts(m))),
        "card": _located(text, "card", CARD, digit, lambda m, b: _yes(F.when(n(_digits(m)).between(14, 19), _luhn(_digits(m))).otherwise(F.lit(False)))),
        "phone": _located(text, "phone", PHONE, has("+"), lambda m, b: _yes(n(_digits(m)).between(10, 15))),
        "iban": _located(text, "iban", IBAN, digit, lambda m, b: _yes(n(F.replace(m, F.lit(" "), F.lit(""))).between(15, 34) & _mod97(m))),
        "local_phone": _located(text, "local_phone", LOCAL_PHONE, digit, lambda m, b: near(b, PHONE_WORDS, 0.3), context=True),
        "ssn": _located(text, "ssn", SSN, digit, lambda m, b: near(b, SSN_WORDS, 0.3), context=True),
        "secret": _located(text, "secret", SECRET, digit & F.rlike(text, F.lit(SECRET_WORDS)), lambda m, b: near(b, SECRET_WORDS, 0.3), context=True),
    }


def _listed(array: Column) -> Column:
    one = F.transform(F.sort_array(array), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    return F.array_join(one, ",")


def find(docs: DataFrame) -> DataFrame:
    """For each row of docs: doc_id, counts of the base kinds, base_sha256 and spans.

    docs needs doc_id and text; other columns are ignored. spans lists
    kind:start:end, by start, then as in KINDS, joined by commas; offsets are
    code points, the end exclusive. base_sha256 is the hash of the base kinds'
    list. Added spans that overlap a base span are left out. A null text counts
    as empty: no spans, the hash of the empty string. Repeated rows give
    repeated rows.
    """
    base = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("_t"))
    kinds = spans(F.col("_t"))
    found = base.select("doc_id", *[c.alias(f"_{k}") for k, c in kinds.items()])
    found = found.withColumn("_base", F.concat(*[F.col(f"_{k}") for k in BASE]))
    added = F.concat(*[F.col(f"_{k}") for k in KINDS[4:]])
    free = _free(added, F.col("_base"))
    return found.select(
        "doc_id",
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(_listed(F.col("_base")), 256).alias("base_sha256"),
        _listed(F.concat("_base", free)).alias("spans"),
    )
