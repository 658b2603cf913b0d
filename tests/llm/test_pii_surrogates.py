"""Surrogates: format, coreference, distinctness, clean texts left alone."""
import re

import pytest
from pyspark.sql import functions as F

from wattgrid.llm import pii_surrogates as P

SCHEMA = "doc_id long, text string, _hits string, TEXT string"
TEXTS = [
    "Call Mrs. Anna MÜLLER at +1 (017) 555-7713 or mail Und.34@Mail7.example.COM now. Mrs. Müller is here.",
    "und.34@mail7.example.com and 233.254.104.120, 9807915762804490 4539 1488 0343 6467; г-жа Анна Петрова; г-н Иван Петров",
    "Κύριος Γιάννης Νικολάου +10175557713 4539-1488-0343-6467 233.254.104.120. 4539148803436467",
    'token = "cf1d64a9a4cd9723e1f4eafc27395915e6868ffa" der 123-45-6789 DE89 3704 0044 0532 0130 00',
    "Mr John Smith met Mr Smith and Mr Paul Smith; Mrs Paul.", None, "",
    "clean: v1.2.3, 12.5 of 2024, 1234567890 Mr. x, a@b, 300.1.1.1 Mister Jones 1.2.3.4.5 $3,000,000",
]


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def run(spark, texts, key="k"):
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], SCHEMA)
    out = P.replace_entities(df, key=key)
    assert out.columns == [*df.columns, "_hits"]
    out = out.toDF("doc_id", "text", "a", "b", "_hits")
    assert out.filter("a <> 'clash' OR b <> 'clash'").count() == 0
    return {r["doc_id"]: r for r in out.collect()}


def test_formats_and_coreference(spark):
    got = {i: r["text"] for i, r in run(spark, TEXTS).items()}
    a = re.fullmatch(r"Call Mrs\. ([A-Z][a-z]+na) ([A-Z]+) at \+1 \((\d{3})\) (\d{3})-(\d{4}) or mail ([A-Z][a-z]{2}\.\d\d@[A-Z][a-z]{3}\d\.[a-z]{7}\.COM) now\. Mrs\. ([A-Z][a-z]+) is here\.", got[0])
    assert a and a[2] == a[7].upper() and "017" != a[3] and a[2] != "MÜLLER"
    b = re.fullmatch(r"([a-z]{3}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com) and ([\d.]+), (9\d{15}) (4\d{3} \d{4} \d{4} \d{4}); г-жа ([А-Я][а-я]+) ([А-Я][а-я]+); г-н ([А-Я][а-я]+) ([А-Я][а-я]+)", got[1])
    assert b and b[1] == a[6].lower() and luhn(b[4]) and b[5].endswith("на") and b[7].endswith("н") and b[6] != b[8]
    assert all(0 < int(x) < 255 for x in b[2].split(".")) and b[2] != "233.254.104.120"
    c = re.fullmatch(r"Κύριος ([Α-Ωα-ω]+) ([Α-Ωα-ω]+) \+1(\d{10}) (4\d{3}-\d{4}-\d{4}-\d{4}) ([\d.]+)\. (\d{16})", got[2])
    assert c and c[3] == a[3] + a[4] + a[5] and c[5] == b[2] and c[4].replace("-", "") == c[6] == b[4].replace(" ", "")
    d = re.fullmatch(r'token = "([0-9a-f]{40})" der (\d{3}-\d\d-\d{4}) (DE\d\d(?: \d{4}){4} \d\d)', got[3])
    assert d and d[1] != "cf1d64a9a4cd9723e1f4eafc27395915e6868ffa" and d[2] != "123-45-6789"
    e = re.fullmatch(r"Mr (\w+) (\w+) met Mr (\w+) and Mr (\w+) (\w+); Mrs (\w+)\.", got[4])
    assert e and e[2] == e[3] == e[5] and e[1] != e[4]
    assert got[5] is None and got[6] == "" and got[7] == TEXTS[7]


def test_key_decides_and_repeats_agree(spark):
    one, again, other = run(spark, TEXTS), run(spark, TEXTS), run(spark, TEXTS, key="other")
    assert {i: r["text"] for i, r in one.items()} == {i: r["text"] for i, r in again.items()}
    assert all(one[i]["text"] != other[i]["text"] for i in range(5))


def test_collisions_are_drawn_again(spark, monkeypatch):
    """With surrogates from a tiny space almost all collide at first; in the end none do."""
    real = P.surrogate

    def tiny(k, c, turn, key):
        return f"concat(cast(100 + pmod(xxhash64({c}, {turn}), 40 + 40 * {turn}) AS string), '@x.com')"
    monkeypatch.setattr(P, "surrogate", tiny)
    texts = [f"mail aa{i}@b.com and aa{i + 1}@b.com, also AA{i}@B.com; 111@x.com" for i in range(30)]
    out = run(spark, texts)
    found = {}
    for i, t in enumerate(texts):
        new = re.findall(r"\d+@x\.com", out[i]["text"].lower())
        for old, s in zip(re.findall(r"\w+@\w\.com", t.lower()), new):
            assert found.setdefault(old, s) == s
    assert len(found) == 32 and len(set(found.values())) == 32
    assert not set(found) & set(found.values())
    monkeypatch.setattr(P, "surrogate", real)


def test_distinct_over_many(spark):
    texts = [f"ip 10.{i // 256}.{i % 256}.7 and +1 (017) 555-{i:04d}, Mr Max Mann{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(600)]
    out = run(spark, texts)
    ips = {out[i]["text"].split(" and ")[0] for i in range(600)}
    phones = {out[i]["text"].split(" and ")[1].split(",")[0] for i in range(600)}
    names = {out[i]["text"].rsplit(" ", 1)[1] for i in range(600)}
    assert len(ips) == 600 and len(phones) == 600 and len(names) == 600


@pytest.mark.parametrize("text", ["a" * 200_000, "1" * 200_000, "a@" * 100_000, "Mr " * 60_000, "+1 " * 60_000, "1.2." * 50_000, "x@y" + ".z" * 50_000])
def test_long_texts_take_linear_time(spark, text):
    assert run(spark, [text + " und.34@mail7.example.com"])[0]["_hits"]


def test_plan_is_native(spark):
    df = P.replace_entities(spark.createDataFrame([(1, TEXTS[0], "", "")], SCHEMA))
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval|MapInArrow", plan)


def test_empty_table_and_stage(spark):
    assert P.replace_entities(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, TEXTS[0], "en", "s", 5, "x"), (None, None, None, None, None, None)], "doc_id long, text string, _hits string, _subs string, n_chars long, Text string")
    out = P.stage(spark, df, "")
    assert out.columns == df.columns and out.count() == 2
    out = out.toDF("doc_id", "text", "a", "b", "n_chars", "c")
    assert out.filter(F.col("n_chars") != F.length("text")).count() == 0 and out.filter("c = 'x' AND a = 'en'").count() == 1


def test_phone_ends_before_the_next_entity(spark):
    after = ["190.137.223.204", "4539 1488 0343 6467", "123-45-6789", "2024", "17 people"]
    phones = ["+1 (826) 555-4081", "+44 20 7946 0958", "+33 1 23 45 67 89", "+49 30 123456"]
    got = run(spark, [f"{p} {a}" for p in phones for a in after])
    for i, r in got.items():
        p, a = phones[i // 5], after[i % 5]
        assert r["_hits"] == ([p, a] if i % 5 < 3 else [p])
        assert r["text"].endswith(" " + a) == (i % 5 > 2) and p not in r["text"]
        assert i % 5 or not set(re.findall(r"\d+\.\d+", r["text"])) & {"137.223", "223.204"}


def test_whole_names_and_untitled_mentions(spark):
    texts = ["Dr Juan Carlos García Márquez came.", "Mr J. Smith and Mr J Smith left.", "Herr Ludwig van Beethoven und Frau Ursula von der Leyen.",
             "Mr John Smith came. Smith said Blacksmith and Smithson heard John; SMITHS, Smith's.", "Smith said so.", "Frau O'Neil-Meyer, then O'Neil-Meyer."]
    got = {i: r["text"] for i, r in run(spark, texts).items()}
    assert not re.search("Juan|Carlos|García|Márquez", got[0]) and re.fullmatch(r"Dr \w+ \w+ \w+ \w+ came\.", got[0])
    b = re.fullmatch(r"Mr ([A-Z])\. (\w+) and Mr ([A-Z]) (\w+) left\.", got[1])
    assert b and b[2] == b[4] != "Smith"
    c = re.fullmatch(r"Herr (\w+) van (\w+) und Frau (\w+) von der (\w+)\.", got[2])
    assert c and not {"Ludwig", "Beethoven", "Ursula", "Leyen"} & set(c.groups())
    d = re.fullmatch(r"Mr (\w+) (\w+) came\. (\w+) said Blacksmith and Smithson heard (\w+); SMITHS, (\w+)'s\.", got[3])
    assert d and d[2] == d[3] == d[5] == b[2] and d[1] == d[4] != "John"
    assert got[4] == texts[4]
    assert "Neil" not in got[5] and len(set(re.findall(r"[A-Z]\w+", got[5]))) == 2


@pytest.mark.parametrize("before, entity, kind", [
    ("-", "anna@example.com", "email"), ("...", "anna@example.com", "email"), ("_", "bob@example.com", "email"), ("%", "bob.b@example.com", "email"),
    ("+", "bob@example.com", "email"), ("7,", "4539148803436467", "card"), ("-", "4539148803436467", "card"), ("", "3782 822463 10005", "card"),
    ("tel ", "555 123 4567", "phone"), ("tel ", "1-800-555-1234", "phone"), ("tel ", "1 800 555 1234", "phone")])
def test_entities_after_marks_and_further_forms(spark, before, entity, kind):
    r = run(spark, [f"{before}{entity}, ok", "0.4539148803436467 and 12,345,678"])
    assert r[0]["_hits"] == [entity] and r[0]["text"].startswith(before) and r[0]["text"].endswith(", ok") and entity not in r[0]["text"]
    assert not r[1]["_hits"] and spark.sql(f"SELECT {P.kind(P._lit(entity))}").first()[0] == kind


def sha(*parts):
    import hashlib
    return hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()


def plain_permuted(c, kind, turn, key, start, upto, hexadecimal=False):
    sets = ["0123456789abcdef"] if hexadecimal else ["0123456789", "abcdefghijklmnopqrstuvwxyz"]
    s = list(c)
    for r in range(P.ROUNDS):
        mine = [start <= i <= upto and i % 2 == r % 2 for i in range(1, len(s) + 1)]
        rest = "".join(next((str(n) for n, a in enumerate(sets) if ch in a), ch) if m else ch for ch, m in zip(s, mine))
        h = sha(key, kind, turn, r, 0, rest) + sha(key, kind, turn, r, 1, rest)
        for i, m in enumerate(mine, 1):
            a = next((a for a in sets if s[i - 1] in a), None)
            if m and a:
                at = 4 * ((i // 2) % 32)
                s[i - 1] = a[(a.index(s[i - 1]) + int(h[at:at + 4], 16)) % len(a)]
    return "".join(s)


def luhn_sum(s, odd):
    return sum((lambda d: d * 2 - (9 if d > 4 else 0) if (len(s) - i) % 2 == odd else d)(int(ch)) for i, ch in enumerate(s, 1))


def plain_surrogate(kind, c, turn, key):
    """The surrogates step by step."""
    if kind == "email":
        return plain_permuted(c, kind, turn, key, 1, c.rindex("."))
    if kind == "phone":
        return plain_permuted(c, kind, turn, key, 2 + max(1, min(3, len(c) - 11)) if c[0] == "+" else 1, len(c))
    if kind == "card":
        b = plain_permuted(c[:-1], kind, turn, key, 2, len(c) - 1)
        return b + str((int(c[-1]) + luhn_sum(c[:-1], 0) - luhn_sum(b, 0)) % 10)
    if kind == "ip":
        s = [int(o) for o in c.split(".")]
        for r in range(P.ROUNDS):
            mine = [1 <= o <= 254 and i % 2 == r % 2 for i, o in enumerate(s)]
            h = sha(key, kind, turn, r, ".".join("#" if m else str(o) for o, m in zip(s, mine)))
            s = [1 + (o - 1 + int(h[6 * i:6 * i + 6], 16)) % 254 if m else o for i, (o, m) in enumerate(zip(s, mine))]
        return ".".join(map(str, s))
    if kind.startswith(("given", "family")):
        h = "".join(sha(key, re.sub("^given_[fmu]", "given", kind), c, turn, n) for n in (0, 1))
        body = "".join("bdfgklmnprstvz"[int(h[3 * i:3 * i + 3], 16) % 14] + "aeiou"[int(h[63 + 3 * i:66 + 3 * i], 16) % 5] for i in range(1 + turn // 4))
        end = {"f": "na", "m": "n"}[kind[6]] if kind.startswith("given") else ["ler", "sen", "rini", "man", "ton", "dez", "nov", "lis"][int(h[-2:], 16) % 8]
        alphabet = {"cyrillic": P.CYRILLIC, "greek": P.GREEK}.get(kind.rsplit("_", 1)[1], P.LATIN)
        return (body + end).translate(str.maketrans(P.LATIN, alphabet))
    return plain_permuted(c, kind, turn, key, 3 if kind == "iban" else 1, len(c), kind == "secret")


def test_surrogates_equal_a_plain_version(spark):
    import random
    rng = random.Random(4)

    def digits(n):
        return "".join(rng.choices("0123456789", k=n))
    every = [("email", f"{rng.choice('abz')}{digits(2)}.x_{i}@mail-{digits(1)}.example.co.uk") for i in range(40)] + [("email", "a@b.co"), ("email", "x" * 64 + "@" + "y" * 60 + ".org")]
    every += [("ip", ".".join(str(rng.randint(0, 255)) for _ in range(4))) for _ in range(40)] + [("ip", "0.0.0.0"), ("ip", "255.1.0.254")]
    every += [("phone", "+" + digits(n)) for n in (8, 11, 12, 15)] + [("phone", digits(10)), ("ssn", digits(9)), ("iban", "de89" + digits(18)), ("iban", "gb29nwbk" + digits(14))]
    every += [("card", digits(n)) for n in range(13, 20) for _ in range(5)] + [("secret", "".join(rng.choices("0123456789abcdef", k=n))) for n in (16, 40, 300)]
    every += [(k, n) for k in ("given_f_latin", "given_m_cyrillic", "family_greek", "family_latin") for n in ("anna", "петр", "o'neil")]
    df = spark.createDataFrame([(k, c, t) for k, c in every for t in (0, 9)], "kind string, canon string, turn int")
    for r in df.withColumn("s", F.expr(P.surrogate("kind", "canon", "turn", "secret key"))).collect():
        assert r["s"] == plain_surrogate(r["kind"], r["canon"], r["turn"], "secret key"), r


@pytest.mark.parametrize("kind, form", [
    ("email", "concat(char(97 + id % 26), id div 26 % 10, '@', char(97 + id div 260), '.io')"), ("ssn", "lpad(id, 9, '0')"), ("card", "concat('4', lpad(id, 14, '0'))"),
    ("ip", "concat_ws('.', id % 256, 10, id div 256, 0)"), ("secret", "lpad(hex(id), 16, '0')")])
def test_no_two_entities_meet(spark, kind, form):
    df = spark.range(6760).select(F.expr(f"lower({form})").alias("c"))
    got = df.withColumn("s", F.expr(P.surrogate(f"'{kind}'", "c", "0", "k"))).select(F.countDistinct("c"), F.countDistinct("s"), F.sum(F.expr("int(s = c)"))).first()
    assert got[0] == got[1] == 6760 and got[2] < 60


def test_one_person_keeps_one_name(spark):
    texts = ["Dr Anna Gray met Mrs Anna Gray and Anna.", "Prof Anna Gray", "Mrs Anna Gray", "Dr Robin Hall, then Mrs Robin Hall", "Dr Paul Hall", "Mr Paul Hall"]
    got = {i: r["text"] for i, r in run(spark, texts).items()}
    a = re.fullmatch(r"Dr (\w+) (\w+) met Mrs (\w+) (\w+) and (\w+)\.", got[0])
    assert a and a[1] == a[3] == a[5] and a[2] == a[4] and got[1] == f"Prof {a[1]} {a[2]}" and got[2] == f"Mrs {a[1]} {a[2]}" and a[1].endswith("na")
    b = re.fullmatch(r"Dr (\w+) (\w+), then Mrs (\w+) (\w+)", got[3])
    assert b and b[1] == b[3] and b[1].endswith("na") and b[2] == b[4] == got[4].split()[2]
    assert got[4].split()[1:] == got[5].split()[1:] and not got[4].split()[1].endswith("na")


def test_repeated_rows_and_long_secrets(spark):
    texts = [TEXTS[0], TEXTS[3]] + [TEXTS[0]] * 30 + ["password: '" + "0f" * 500 + "'"]
    out = run(spark, texts)
    alone = run(spark, texts[:2])
    assert {out[i]["text"] for i in (0, *range(2, 32))} == {alone[0]["text"]} and out[1]["text"] == alone[1]["text"]
    assert "0f0f0f" not in out[32]["text"] and len(out[32]["text"]) == len(texts[32])


def test_no_text_is_shuffled_for_redraws(spark):
    """Thousands of names: whatever is drawn again, the result's own plan holds no exchange."""
    texts = [f"Mr Abc{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)} Jones" for i in range(2000)]
    df = P.replace_entities(spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], SCHEMA))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    names = [r["text"].split()[1] for r in df.collect()]
    assert len(set(names)) == 2000
