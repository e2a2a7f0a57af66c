"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score. Spark expressions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, scan, settled

#: Characters before and after a span in which context words count.
CONTEXT = 48
#: Score that a span must reach.
THRESHOLD = 0.5


@dataclass(frozen=True)
class Kind:
    """``pattern`` must begin where a match can begin and never give back what it took, so that a text is read once (an IBAN's few characters ahead excepted).

    ``guard`` is a cheap test that every text with a match passes.
    """

    name: str
    pattern: str
    guard: str
    score: float
    context: str


# A match begins at the start of a run of its characters or right after the last match (\G), else an earlier start would match, too.
EMAIL = Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, r"mail|contact|write")
IP = Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.6, r"\bip\b|address|server|host")
CARD = Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])", r"[0-9](?:[\x20-]?[0-9]){12}", 0.8, r"card|visa|credit|payment")
PHONE = Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.6, r"phone|call|tel|mobile")
# A match is only the head; group 3 is the text in which it may end, and the character after it if that forbids an end there.
IBAN = Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?:\x20?+[A-Z0-9]){11,30}+[A-Za-z0-9]?))", "[A-Z]{2}[0-9]{2}", 0.9, r"iban|account|bank")
# Without a checksum, a social security number needs a word that says so, near it or near a number of the same list.
SSN = Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.3, r"\bssns?\b|social security")
BASE = (EMAIL, IP, CARD, PHONE)
KINDS = (*BASE, IBAN, SSN)
CONTEXT_BONUS = 0.3

#: Length of an IBAN by country. Codes that are not here may have any length from 15 to 34.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}

_BYTE = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(digits)

    def add(acc: Column, i: Column) -> Column:
        x = back.substr(i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return acc + F.floor(x / 10).cast("int") + x % 10

    total = F.aggregate(F.sequence(F.lit(1), F.length(back)), F.lit(0), add)
    return (F.length(digits) > 0) & (total % 10 == 0)


def iban_length(head: Column, tail: Column) -> Column:
    """Characters from the start of ``head`` (country and check digits) to the end of an IBAN that ends in ``tail``, 0 if there is none.

    An IBAN leaves 1 when divided by 97 and ends where no letter or digit follows, after as many as its country has; of an unknown country, the longest counts.
    """
    letter = lambda i: F.ascii(head.substr(i, 1)) - 55
    moved = letter(1) * 10_000 + letter(2) * 100 + head.substr(3, 2).try_cast("int")
    fixed = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])[head.substr(1, 2)]

    def add(acc: Column, i: Column) -> Column:
        c, following = tail.substr(i, F.lit(1)), tail.substr(i + 1, F.lit(1))
        code = F.ascii(c)
        value = F.when(c == " ", acc["value"]).when(code < 58, acc["value"] * 10 + code - 48).otherwise(acc["value"] * 100 + code - 55) % 97
        n = acc["n"] + F.when(c == " ", 0).otherwise(1)
        ends = c.rlike("[A-Z0-9]") & following.isin("", " ") & (n == F.coalesce(fixed, n)) & n.between(15, 34)
        return F.struct(value.cast("long").alias("value"), n.alias("n"), F.when(ends & ((value * 1_000_000 + moved) % 97 == 1), i).otherwise(acc["end"]).alias("end"))

    start = F.struct(F.lit(0).cast("long").alias("value"), F.lit(4).alias("n"), F.lit(0).alias("end"))
    end = F.aggregate(F.sequence(F.lit(1), F.length(tail)), start, add)["end"]
    return F.when(end > 0, end + 4).otherwise(0)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _valid(kind: Kind, match: Column) -> Column:
    if kind is IP:
        return match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind is CARD:
        return luhn(_digits(match))
    if kind is PHONE:
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


SPAN = "struct<kind:string,start:bigint,end:bigint,score:double,text:string>"


def _candidates(kind: Kind, text: Column) -> Column:
    """``(gap, hit, tail)``: a search takes the text up to a match and the match, or the rest of the text, so that lengths add up to positions. Only an IBAN has a tail."""
    search = F.lit(rf"(?s)(.*?)({kind.pattern}|\z)")
    gaps, hits = (F.regexp_extract_all(text, search, F.lit(k)) for k in (1, 2))
    tails = F.regexp_extract_all(text, search, F.lit(3)) if kind is IBAN else F.transform(hits, lambda h: F.lit(""))
    found = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), tails.alias("tail"))
    return F.when(text.rlike(kind.guard), found).otherwise(F.array().cast("array<struct<gap:string,hit:string,tail:string>>"))


def _spans_of(kind: Kind, found: Column) -> Column:
    """The spans of one kind that pass its check in order of their start, scored without context."""

    def step(v: Column, at: Column) -> Column:
        start = at + F.length(v["gap"])
        hit = v["hit"]
        if kind is IBAN:
            size = iban_length(hit, v["tail"])
            hit = F.when(size > 0, F.concat(hit, v["tail"].substr(F.lit(1), size - 4))).otherwise("")
        return F.struct(F.lit(kind.name).alias("kind"), start.cast("long").alias("start"), (start + F.length(hit)).cast("long").alias("end"), F.lit(kind.score).alias("score"), hit.alias("text"))

    placed = scan(found, F.lit(0), lambda at, v: at + F.length(v["gap"]) + F.length(v["hit"]), step, lambda a, b: a + b, SPAN)
    return F.filter(placed, lambda s: (s["end"] > s["start"]) & _valid(kind, s["text"]))


def _apart(spans: Column) -> Column:
    """The spans without those that begin within an earlier one that stays."""
    after = lambda at, v: F.when(v["start"] >= at, v["end"]).otherwise(at)
    marked = scan(spans, F.lit(0), after, lambda v, at: F.struct(v.alias("span"), (v["start"] >= at).alias("stays")), None, f"struct<span:{SPAN},stays:boolean>")
    return F.transform(F.filter(marked, lambda m: m["stays"]), lambda m: m["span"])


_NEAR = f"struct<span:{SPAN},near:boolean,joined:boolean>"
_AND = r"^[^\p{L}\p{N}]*(?:(?:and|or|und|oder|et|ou|y|o)[^\p{L}\p{N}]+)?$"


def _near(kind: Kind, spans: Column, text: Column) -> Column:
    """Every span with whether a context word is ``near`` and whether it is ``joined`` to the span before as in a list: by no words but "and".

    Texts around the spans are cut in two steps, sections of neighbouring spans and then within a section, since cutting counts characters from the start.
    """
    block = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(spans)))).cast("int")
    starts = F.when(F.size(spans) > 0, F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / block).cast("int"))).otherwise(F.array().cast("array<int>"))

    def section(b: Column) -> Column:
        part = F.slice(spans, b * block + 1, block)
        before = F.when(b > 0, F.get(spans, b * block - 1)["end"]).otherwise(F.lit(0).cast("long"))
        first = F.greatest(F.lit(0).cast("long"), part[0]["start"] - CONTEXT)
        own = text.substr((first + 1).cast("int"), (F.element_at(part, -1)["end"] + CONTEXT - first).cast("int"))
        held = F.array(F.struct(part.alias("part"), own.alias("own"), first.alias("first"), F.concat(F.array(before), F.transform(part, lambda s: s["end"])).alias("ends")))
        return F.flatten(F.transform(held, lambda h: F.transform(h["part"], lambda s, i: judged(h, s, F.get(h["ends"], i)))))

    def judged(h: Column, s: Column, last: Column) -> Column:
        cut = lambda a, z: h["own"].substr((a - h["first"] + 1).cast("int"), (z - a).cast("int"))
        left, right = cut(F.greatest(h["first"], s["start"] - CONTEXT), s["start"]), cut(s["end"], s["end"] + CONTEXT)
        near = F.lower(left).rlike(kind.context) | F.lower(right).rlike(kind.context)
        joined = (s["start"] - last).between(0, CONTEXT) & F.lower(F.right(left, (s["start"] - last).cast("int"))).rlike(_AND)
        return F.struct(s.alias("span"), near.alias("near"), (joined & (last > 0)).alias("joined"))

    return F.flatten(F.transform(starts, section)).cast(f"array<{_NEAR}>")


def _carried(marked: Column) -> Column:
    """``near`` handed on from each span to the following ones of its list."""
    reach = lambda at, v: F.when(v["near"], 1).when(v["joined"], at).otherwise(0).cast("long")
    return scan(marked, F.lit(0), reach, lambda v, at: F.struct(v["span"].alias("span"), (v["near"] | (v["joined"] & (at > 0))).alias("near"), v["joined"].alias("joined")), None, _NEAR)


def _turned(marked: Column) -> Column:
    """The other way round: the spans from the last to the first, each ``joined`` to the one that followed it."""
    joins = F.concat(F.slice(F.transform(marked, lambda v: v["joined"]), 2, F.greatest(F.size(marked), F.lit(1))), F.array(F.lit(False)))
    turned = F.reverse(F.zip_with(marked, joins, lambda v, j: F.struct(v["span"].alias("span"), v["near"].alias("near"), j.alias("joined"))))
    return F.when(F.size(marked) > 0, turned).otherwise(marked)


def _scored(marked: Column) -> Column:
    """The spans whose score with context is enough."""

    def scored(v: Column) -> Column:
        s = v["span"]
        score = F.least(F.lit(1.0), s["score"] + F.when(v["near"], CONTEXT_BONUS).otherwise(0.0))
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), score.alias("score"), s["text"].alias("text"))

    return F.filter(F.transform(marked, scored), lambda s: s["score"] >= THRESHOLD)


def with_spans(df: DataFrame, text: str, out: str, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``df`` and a column ``out`` of ``array<struct<kind, start, end, score, text>>``: confirmed spans by kind as listed, then by start.

    Positions are code points, the end exclusive. Of one kind, matches are the leftmost and don't overlap; a match that its check
    rejects is not tried again from another start, except that IBANs are sought from every start. Filter other columns before, not after (``settled``).
    Context words count within ``CONTEXT`` characters before or after a match, whatever matches stand between, and for all numbers of a list. Spans of different kinds may overlap. A null text is empty.
    """
    names = {kind: fresh(df, f"found_{kind.name}") for kind in kinds}
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = df.withColumns({name: _candidates(kind, whole) for kind, name in names.items()})
    found = found.withColumns({name: _spans_of(kind, F.col(name)) for kind, name in names.items()})
    if IBAN in names:
        found = found.withColumn(names[IBAN], _apart(F.col(names[IBAN])))
    needy = {kind: name for kind, name in names.items() if kind.score < THRESHOLD}
    found = found.withColumns({name: _near(kind, F.col(name), whole) if kind in needy else _scored(_near(kind, F.col(name), whole)) for kind, name in names.items()})
    for step in (_carried, _turned, lambda marked: _scored(F.reverse(_carried(marked)))):
        found = found.withColumns({name: step(F.col(name)) for name in needy.values()})
    return found.withColumn(out, settled(F.concat(*names.values()))).drop(*names.values())


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, spans`` of every row, without a shuffle. Null ids and repeated rows are kept as they are; other columns are not read."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return with_spans(rows, "text", "spans").select("doc_id", "spans")


def joined(found: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The documents with every span replaced by its kind in brackets, with all their columns; ``n_chars``, where there is such a column, is counted anew.

    Overlapping spans become one, named by the first. Null texts stay null. Pieces of a text are cut in two steps, sections of neighbouring
    spans and then within a section, since cutting counts characters from the start.
    """
    found, last, after = (fresh(docs, name) for name in ("spans", "last", "after"))
    cuts = "struct<start:bigint,before:bigint,kind:string>"
    reach = lambda at, v: F.greatest(at, v["end"])
    out = with_spans(docs, text, found)
    out = out.withColumn(found, F.array_sort(F.transform(found, lambda s: F.struct(s["start"], s["end"], s["kind"]))))
    out = out.withColumn(last, F.aggregate(found, F.lit(-1).cast("long"), reach))
    merged = scan(F.col(found), F.lit(-1), reach, lambda v, at: F.struct(v["start"].alias("start"), at.alias("before"), v["kind"].alias("kind")), F.greatest, cuts)
    out = out.withColumn(found, F.filter(merged, lambda v: v["start"] >= v["before"]))
    out = out.withColumn(after, F.concat(F.slice(F.transform(found, lambda v: v["before"]), 2, F.greatest(F.size(found), F.lit(1))), F.array(last)))
    pieces = F.zip_with(found, after, lambda v, e: F.struct(F.greatest(v["before"], F.lit(0)).alias("after"), v["start"].alias("start"), e.alias("end"), v["kind"].alias("kind")))
    out = out.withColumn(found, pieces)
    block = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(found)))).cast("int")
    starts = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / block).cast("int"))
    whole = F.col(text)

    def section(part: Column) -> Column:
        base = part[0]["after"]
        own = whole.substr((base + 1).cast("int"), (F.element_at(part, -1)["end"] - base).cast("int"))
        kept = lambda c: own.substr((c["after"] - base + 1).cast("int"), (c["start"] - c["after"]).cast("int"))
        return F.array_join(F.transform(part, lambda c: F.concat(kept(c), F.lit("["), F.upper(c["kind"]), F.lit("]"))), "")

    body = F.array_join(F.transform(starts, lambda b: section(F.slice(found, b * block + 1, block))), "")
    masked = F.when(F.size(found) > 0, F.concat(body, whole.substr((F.col(last) + 1).cast("int"), F.length(whole)))).otherwise(whole)
    out = out.withColumn(text, settled(masked))
    if n_chars in docs.columns:
        out = out.withColumn(n_chars, F.length(text).cast(docs.schema[n_chars].dataType))
    return out.select(*docs.columns)
