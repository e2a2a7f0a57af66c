import random
import re

from pyspark.sql import functions as F

from dictspark.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    """Leftmost non-overlapping matches of the plain patterns, then the checks."""
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end(), m[0]))
    return out


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans", F.lit(1))
    return {r.doc_id: [(s.kind, s.start, s.end, s.text) for s in r.spans] for r in pii.find(docs).collect()}


def test_base_spans_against_plain_patterns(spark):
    rng = random.Random(8)
    parts = ["a.b@c.de", "x@y", "1.2.3.4", "300.1.2.3", ".5", "4111 1111 1111 1111", "4539-1488-0343-6467", "79927398713", "+49 (30) 123-4567", "+1", "é", "𝄞", " ", "-", "  ", "@", ".", "_", "7", "0", "+", "(", "word", "\n", "_d@e.f"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 25))) for _ in range(1500)]
    texts += [None, "", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "a" * 50_000, "1" * 50_000, "+1 " * 20_000, "a@b" + ".c" * 30_000, "1.2." * 20_000, "- 4" * 20_000]
    got = found(spark, texts)
    for i, text in enumerate(texts):
        assert [s for s in got[i] if s[0] in BASE] == brute(text), text


def test_many_spans_in_a_long_text(spark):
    text = "".join(f"é mail{i}@ex.org " for i in range(20_000))
    assert found(spark, [text])[0] == brute(text)


def test_checksums_and_context(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00.", "DE89 3704 0044 0532 0130 01", "GB82WEST12345698765432", "ssn 123-45-6789", "part 123-45-6789"]
    got = found(spark, texts)
    kinds = [[s[0] for s in got[i] if s[0] in ("iban", "ssn")] for i in range(len(texts))]
    assert kinds == [["iban"], [], ["iban"], ["ssn"], []]


def test_ibans_before_other_characters(spark):
    de, gb, spaced, no = "DE89370400440532013000", "GB82WEST12345698765432", "DE89 3704 0044 0532 0130 00", "NO9386011117947"
    unknown = "ZZ08ABCD12345678901"
    expected = {
        f"{de} The money": [de], f"{gb} Please": [gb], f"{spaced} BIC COBADEFF": [spaced], f"{de} 500 EUR": [de], f"{de} {gb}": [de, gb], f"é {spaced} {de} {gb} {no} X": [spaced, de, gb, no],
        f"AB12 {de} A": [de], f"DE12 {spaced} 7": [spaced], f"{de}0": [], f"{de}a": [], f"x{de}": [], f"{spaced[:-1]}1 The": [], f"{no}, {no}\n{no}": [no] * 3, f"{unknown} Then": [unknown], f"{unknown} {de}": [unknown, de],
    }
    got = found(spark, list(expected))
    for i, (text, ibans) in enumerate(expected.items()):
        own = [s for s in got[i] if s[0] == "iban"]
        assert [s[3] for s in own] == ibans and all(text[a:b] == t for _, a, b, t in own), text
    many = f"{de} The " * 5000
    assert len([s for s in found(spark, [many])[0] if s[0] == "iban"]) == 5000


def test_numbers_in_lists_and_words_after_them(spark):
    a, b = "123-45-6789", "987-65-4321"
    many = [f"{i:03}-{i % 90 + 10}-{i + 1000}" for i in range(300)]
    expected = {
        f"ssn {a}, {b}": [a, b], f"{a} (SSN)": [a], f"SSNs: {a}; {b} and {a}": [a, b, a], f"ssn | {a} | {b} | {a} | {b} | {a} | {b}": [a, b] * 3, f"{a}, {b}, {a}, {b}, {a}, {b} are social security numbers": [a, b] * 3,
        f"𝄞é SSN {a} of Ann, {b} of Bob": [a, b], f"part {a}, {b}": [], f"ssn {a} {'x' * 60} {b}": [a], f"issn {a}": [], f"ssn {'x' * 60} {a}": [], f"{a} {'x' * 60} ssn": [], "SSN\n" + "\n".join(many): many,
    }
    got = found(spark, list(expected))
    for i, (text, numbers) in enumerate(expected.items()):
        own = [s for s in got[i] if s[0] == "ssn"]
        assert [s[3] for s in own] == numbers and all(text[x:y] == t for _, x, y, t in own), text
    docs = spark.createDataFrame([(1, f"ssn {a}, {b}")], "doc_id long, text string")
    assert pii.redact(docs).first().text == "ssn [SSN], [SSN]"


def test_redact(spark):
    rows = [
        (1, "to a@b.de or +49 30 1234567 now", "x", 5),
        (2, None, "y", None),
        (3, "", "z", 0),
        (4, "é𝄞 a@b.c_d@e.f", "w", 1),
        (None, "+49 123 456 789.foo@x.com!", "v", 2),
        (None, "+49 123 456 789.foo@x.com!", "v", 2),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_chars long").withColumn("LAST", F.lit(1))
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert [(r.text, r.n_chars, r.spans) for r in out.collect()] == [
        ("to [EMAIL] or [PHONE] now", 25, "x"), (None, None, "y"), ("", 0, "z"), ("é𝄞 [EMAIL][EMAIL]", 17, "w"), ("[PHONE]!", 8, "v"), ("[PHONE]!", 8, "v"),
    ]
    assert pii.redact(docs.limit(0)).count() == 0
    many = "".join(f"é m{i}@ex.org," for i in range(3000))
    assert pii.redact(spark.createDataFrame([(many,)], "text string")).first()[0] == re.sub(BASE["email"], "[EMAIL]", many)


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = pii.find(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_plans_stay_small_under_filters(spark):
    docs = spark.createDataFrame([(1, "mail a@b.co, ssn 123-45-6789", 28), (2, "none", 4)], "doc_id long, text string, n_chars int")
    size = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString())
    plain, masked = pii.find(docs), pii.redact(docs)
    assert size(plain.where("size(spans) > 0 AND spans[0].start > 1")) < 1.1 * size(plain)
    assert size(masked.where("length(text) > 3 AND n_chars > 3").groupBy("text").count()) < 1.1 * size(masked)
    assert [r.doc_id for r in plain.where("size(spans) > 0").collect()] == [1]
    assert [r.text for r in masked.where("n_chars > 4").collect()] == ["mail [EMAIL], ssn [SSN]"]
