"""Surrogates for personal data, in DataFrame and SQL expressions alone.

Detected entities (e-mail addresses, IP addresses, phone, card and social security numbers, IBANs,
keys in assignments, names after a title) give way to made-up ones that a secret key and the
entity's canonical form decide. So every mention of an entity, in any document and in
any spelling that differs only in case or separators, gets the same surrogate; parts of names
are replaced one by one, so "Dr Anna Gray" and "Dr Gray" stay the same person. Particles stay, initials become
the surrogate's; a part found after a title is also replaced where the document has it without one (such bare
mentions are replaced, not listed as mentions).

Surrogates keep type and format: length, separators, letter case and digits' places, country
codes and top-level domains, a card number's first digit and whether its check digit is true; names keep the
gender their title tells, their script (Latin, Cyrillic or Greek) and capitals. After a neutral title, the
gender is that of the name's other mentions in the document, else what its ending suggests.

Distinctness: all kinds but names are permuted within their format by a keyed network of rounds that can be
undone, so no two entities can meet. Names are hashed to syllables, as many as the number of distinct names
needs. The table of all distinct entities is then checked: a kind in which two entities share a surrogate, or
a surrogate is an entity of the corpus, is drawn again as a whole. A draw is one number a kind, so all
surrogates are computed in place: no text is shuffled, whatever is drawn again. Where entities fill so much of
a format that every draw meets some (social security numbers by the million), the draw with fewest is taken.

Defined results: texts without entities, NULL and empty ones stay as they are; repeats are
replaced alike; an empty table gives no rows; other columns pass through.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import masked, place_of, table, written

KEY = "wattgrid"  # the secret of the surrogates; give your own

# Titles before names, with the gender they tell, and letters of other scripts.
TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Mme", "Mlle", "г-жа", "госпожа", "Κυρία"],
    "m": ["Mr", "Herr", "Señor", "Monsieur", "г-н", "господин", "Κύριος"],
    "u": ["Dr", "Prof"],
}
LATIN = "abdefgiklmnoprstuvz"
CYRILLIC = "абдефгиклмнопрстувз"
GREEK = "αβδεφγικλμνοπρστυωζ"

_ALL_TITLES = "|".join(t for ts in TITLES.values() for t in ts)
_NAME = r"\p{Lu}[\p{L}'’-]+"
_PARTICLE = r"(?:v[ao]n(?: de[nmr])?|de(?: l[ao]s?)?|del|della|di|da|dos|du|ter|ten|bin|ibn|al|el|af|av)"
_PART = rf"(?:{_PARTICLE} )?(?:{_NAME}|\p{{Lu}}\.?(?= (?:{_PARTICLE} )?\p{{Lu}}))"  # an initial has a further part after it
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_OTHER = rf"(?!(?:19|20)[0-9]{{2}}(?![0-9]|[ .-][0-9])|(?:{_OCTET}\.){{3}}|(?:[0-9]{{4}}[ -]){{3}}[0-9]{{4}}|[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}})"
# Every quantifier is bounded or starts at a word's start only, so long texts take linear time.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,6}\.[A-Za-z]{2,18}(?![A-Za-z0-9])",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)",
    # country codes with a fixed count of digits after them, in any grouping; other codes by groups, which end
    # before a year, an IP address, a card or a social security number; then numbers without a country code
    "phone": (r"(?<![\w+])\+[0-9]{8,15}(?!\w)|(?<![\w+])\+(?:(?:1|7|20|27|30|44|52|54|57|90|91)(?:[ .()-]{0,2}[0-9]){10}|(?:31|33|34|41|48|61|351)(?:[ .()-]{0,2}[0-9]){9})(?!\w)"
              rf"|(?<![\w+])\+[0-9]{{1,3}}[ .-]?(?:\([0-9]{{1,4}}\)|[0-9]{{1,4}})[ .-]?(?:[0-9]{{5,8}}(?!\w)|[0-9]{{2,4}}(?!\w)(?:[ .-]{_OTHER}[0-9]{{2,8}}(?!\w|\.[0-9])){{0,3}})"
              r"|(?<!\w)\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?!\w)|(?<![\w.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![\w-])"
              r"|(?<!\w)(?<![0-9][ .,-])(?:1[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![\w-])"),
    "card": r"(?<!\w)(?:[0-9]{4}[ -]){3}[0-9]{4}(?!\w)|(?<!\w)3[0-9]{3}[ -][0-9]{6}[ -][0-9]{4,5}(?!\w)|(?<!\w)(?<![0-9]\.|\w-)[0-9]{13,19}(?!\w)",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "iban": r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "secret": r"(?<=(?i:token|secret|api_key|apikey|password) {0,2}[=:] {0,2}[\"'])[0-9A-Fa-f]{16,}+(?=[\"'])",
    "name": rf"(?<![\p{{L}}-])(?:{_ALL_TITLES})\.? {_PART}(?: {_PART}){{0,30}}",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def mentions(text: str) -> str:
    """SQL: all mentions in the column ``text``, in order. Texts with no digit, ``@`` or title are not searched."""
    some = " OR ".join([f"{text} RLIKE '[0-9@]'", *(f"contains({text}, {_lit(t + ' ')}) OR contains({text}, {_lit(t + '. ')})" for ts in TITLES.values() for t in ts)])
    return f"CASE WHEN {some} THEN regexp_extract_all({text}, {_lit(PATTERN)}, 0) ELSE array() END"


def kind(m: str) -> str:
    """SQL: the kind of a mention, by its form."""
    tests = [("email", f"contains({m}, '@')"), ("name", f"{m} RLIKE {_lit('^(?:' + _ALL_TITLES + r')\.? ')}"),
             ("ip", f"{m} RLIKE {_lit(r'^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$')}"), ("ssn", f"{m} RLIKE {_lit('^[0-9]{3}-[0-9]{2}-[0-9]{4}$')}"),
             ("phone", f"{m} RLIKE {_lit(r'^[+(]|^[0-9]{3}[.-]|^(?:1[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}$')}"), ("card", f"{m} RLIKE {_lit('^[0-9 -]+$')}"),
             ("iban", f"{m} RLIKE '^[A-Z]{{2}}[0-9]{{2}}[A-Z0-9 ]+$' AND NOT {m} RLIKE '^[0-9A-F]+$'")]
    return "CASE " + " ".join(f"WHEN {test} THEN '{k}'" for k, test in tests) + " ELSE 'secret' END"


def _parts(m: str) -> str:
    """SQL: the parts of a name after its title."""
    return f"slice(split({m}, ' '), 2, 99)"


def _in_form(t: str, n: str) -> str:
    """SQL: surrogate ``n`` in the form of name part ``t``: a particle, an initial, capitals or a plain name."""
    return (f"CASE WHEN {t} = lower({t}) THEN {t} WHEN {t} RLIKE {_lit(r'^\p{Lu}\.?$')} THEN concat(upper(left({n}, 1)), substr({t}, 2)) "
            f"WHEN {t} = upper({t}) THEN upper({n}) ELSE initcap({n}) END")


def units(m: str) -> str:
    """SQL: what of a mention is replaced, as ``array<struct<kind, canon>>``: a name's parts, else the
    whole in lower case and, where separators or leading zeros tell nothing, without them."""
    k = kind(m)
    gender = "CASE " + " ".join(f"WHEN {m} RLIKE {_lit('^(?:' + '|'.join(ts) + r')\b')} THEN '{g}'" for g, ts in TITLES.items() if g != "u") + " ELSE 'u' END"
    script = f"CASE WHEN t RLIKE {_lit(r'\p{IsCyrillic}')} THEN 'cyrillic' WHEN t RLIKE {_lit(r'\p{IsGreek}')} THEN 'greek' ELSE 'latin' END"
    parts = _parts(m)
    name = (f"transform({parts}, (t, i) -> struct(CASE WHEN t = lower(t) THEN 'particle' ELSE concat(CASE WHEN i = size({parts}) - 1 THEN 'family' ELSE concat('given_', {gender}) END, '_', {script}) END AS kind, "
            f"lower(t) AS canon))")
    bare = f"lower(regexp_replace({m}, '[^0-9A-Za-z+]', ''))"
    octets = f"array_join(transform(split({m}, '[.]'), o -> cast(int(o) AS string)), '.')"
    one = f"array(struct({k} AS kind, CASE WHEN {k} = 'ip' THEN {octets} WHEN {k} IN ('email', 'secret') THEN lower({m}) ELSE {bare} END AS canon))"
    return f"CASE WHEN {k} = 'name' THEN {name} ELSE {one} END"


def space(k: str) -> str:
    """SQL: the space that kind ``k`` draws from: names of any gender share theirs."""
    return f"regexp_replace({k}, '^given_[fmu]', 'given')"


def resolved(us: str) -> str:
    """SQL: a document's ``us`` (an array of units for each mention) with the gender of given names after neutral
    titles: that of another mention of the name in the document, else what the name's ending suggests."""
    told = f"filter(flatten({us}), v -> v.kind LIKE 'given_f%' OR v.kind LIKE 'given_m%')"
    same = "try_element_at(transform(filter(told, v -> v.canon = u.canon), v -> substr(v.kind, 7, 1)), 1)"
    gender = f"coalesce({same}, CASE WHEN u.canon RLIKE '[aаяηα]$' THEN 'f' ELSE 'm' END)"
    return (f"transform(array({told}), told -> transform({us}, one -> transform(one, u -> "
            f"CASE WHEN u.kind LIKE 'given_u%' THEN struct(concat('given_', {gender}, substr(u.kind, 8)) AS kind, u.canon AS canon) ELSE u END)))[0]")


ROUNDS = 6


def permuted(c: str, k: str, turn: str, key: str, start: str, upto: str, hexadecimal: bool = False) -> str:
    """SQL: a keyed permutation of the strings in the form of ``c`` (same classes at the same places): two
    strings never meet. In each round the characters at every second place between ``start`` and ``upto`` move
    within their class by amounts that depend on all others, so each round can be undone."""
    def moved(alphabet: str) -> str:
        amount = "cast(conv(substr(h, 1 + 4 * pmod(i div 2, 32), 4), 16, 10) AS int)"
        return f"substr('{alphabet}', 1 + pmod(instr('{alphabet}', substr(s, i, 1)) - 1 + {amount}, {len(alphabet)}), 1)"
    classes = [("[0-9a-f]", "0123456789abcdef")] if hexadecimal else [("[0-9]", "0123456789"), ("[a-z]", "abcdefghijklmnopqrstuvwxyz")]
    mine = f"i >= {start} AND i <= {upto} AND pmod(i, 2) = pmod(r, 2)"
    whole = "sequence(1, length(s))"
    rest = f"array_join(transform({whole}, i -> CASE WHEN {mine} THEN {' '.join(f"WHEN substr(s, i, 1) RLIKE '{p}' THEN '{n}'" for n, (p, _) in enumerate(classes)).join(('CASE ', ' ELSE substr(s, i, 1) END'))} ELSE substr(s, i, 1) END), '')"

    def stream(n: int) -> str:
        return f"sha2(concat_ws('|', {_lit(key)}, {k}, cast({turn} AS string), cast(r AS string), '{n}', rest), 256)"
    step = f"array_join(transform({whole}, i -> CASE WHEN NOT ({mine}) THEN substr(s, i, 1) {' '.join(f"WHEN substr(s, i, 1) RLIKE '{p}' THEN {moved(a)}" for p, a in classes)} ELSE substr(s, i, 1) END), '')"
    # an array of one binds a value that is used many times
    one = f"transform(transform(array({rest}), rest -> concat({stream(0)}, {stream(1)})), h -> {step})[0]"
    return f"CASE WHEN length({c}) > 0 THEN aggregate(sequence(0, {ROUNDS - 1}), {c}, (s, r) -> {one}) ELSE {c} END"


def _addresses(c: str, k: str, turn: str, key: str) -> str:
    """SQL: the same over the four numbers of an IP address; 0 and 255 stay."""
    free = "o BETWEEN 1 AND 254"
    rest = f"concat_ws('.', transform(s, (o, i) -> CASE WHEN {free} AND pmod(i, 2) = pmod(r, 2) THEN '#' ELSE cast(o AS string) END))"
    hash_ = f"sha2(concat_ws('|', {_lit(key)}, {k}, cast({turn} AS string), cast(r AS string), {rest}), 256)"
    step = (f"transform(s, (o, i) -> CASE WHEN {free} AND pmod(i, 2) = pmod(r, 2) THEN 1 + pmod(o - 1 + cast(conv(substr(h, 1 + 6 * i, 6), 16, 10) AS int), 254) ELSE o END)")
    start = f"transform(split({c}, '[.]'), o -> int(o))"
    return f"array_join(transform(aggregate(sequence(0, {ROUNDS - 1}), {start}, (s, r) -> transform(array({hash_}), h -> {step})[0]), o -> cast(o AS string)), '.')"


def surrogate(k: str, c: str, turn: str, key: str) -> str:
    """SQL: the canonical surrogate of canonical form ``c`` of kind ``k`` in draw ``turn``. All kinds but names are
    permuted within their format; names are made of syllables, ``1 + turn div 4`` of them, and an ending."""
    def chars(text: str, start: str, upto: str, hexadecimal: bool = False) -> str:
        return permuted(text, k, turn, key, start, upto, hexadecimal)

    def luhn(s: str, odd: str) -> str:
        """Luhn sum of the digits of ``s``; places of parity ``odd`` from the right count double."""
        return (f"aggregate(sequence(1, length({s})), 0, (a, i) -> a + CASE WHEN pmod(length({s}) - i, 2) = {odd} THEN "
                f"int(substr({s}, i, 1)) * 2 - CASE WHEN int(substr({s}, i, 1)) > 4 THEN 9 ELSE 0 END ELSE int(substr({s}, i, 1)) END)")

    email = chars(c, "1", f"length({c}) - length(regexp_extract({c}, {_lit(r'\.[a-z]+$')}, 0))")
    # country code and its plus sign stay: at most three digits, of which one at least where ten others follow
    code = f"CASE WHEN left({c}, 1) = '+' THEN 2 + greatest(1, least(3, length({c}) - 11)) ELSE 1 END"
    phone = chars(c, code, f"length({c})")
    # what the check digit is off by stays the same, so true numbers stay true and others false
    body = f"substr({c}, 1, length({c}) - 1)"
    off = f"int(right({c}, 1)) + {luhn(body, '0')} - {luhn('b', '0')}"
    card = f"transform(array({chars(body, '2', f'length({c}) - 1')}), b -> concat(b, cast(pmod({off}, 10) AS string)))[0]"
    secret = chars(c, "1", f"length({c})", True)
    iban = chars(c, "3", f"length({c})")
    h = f"concat({', '.join(f"sha2(concat_ws('|', {_lit(key)}, {space(k)}, {c}, cast({turn} AS string), '{n}'), 256)" for n in (0, 1))})"
    syllable = ("concat(substr('bdfgklmnprstvz', 1 + pmod(int(conv(substr(h, i * 3 + 1, 3), 16, 10)), 14), 1), "
                "substr('aeiou', 1 + pmod(int(conv(substr(h, 64 + i * 3, 3), 16, 10)), 5), 1))")
    end = (f"CASE WHEN {k} LIKE 'given_f%' THEN 'na' WHEN {k} LIKE 'given_m%' THEN 'n' WHEN {k} LIKE 'given%' THEN 'ne' "
           f"ELSE element_at(array('ler', 'sen', 'rini', 'man', 'ton', 'dez', 'nov', 'lis'), 1 + pmod(int(conv(right(h, 2), 16, 10)), 8)) END")
    latin = f"transform(array({h}), h -> concat(array_join(transform(sequence(0, least(15, {turn} div 4)), i -> {syllable}), ''), {end}))[0]"
    name = (f"CASE WHEN {k} LIKE '%cyrillic' THEN translate({latin}, '{LATIN}', '{CYRILLIC}') "
            f"WHEN {k} LIKE '%greek' THEN translate({latin}, '{LATIN}', '{GREEK}') ELSE {latin} END")
    return (f"CASE {k} WHEN 'particle' THEN {c} WHEN 'email' THEN {email} WHEN 'ip' THEN {_addresses(c, k, turn, key)} WHEN 'phone' THEN {phone} WHEN 'ssn' THEN {chars(c, '1', f'length({c})')} "
            f"WHEN 'card' THEN {card} WHEN 'iban' THEN {iban} WHEN 'secret' THEN {secret} ELSE {name} END")


def rendered(m: str, subs: str) -> str:
    """SQL: mention ``m`` with the canonical surrogates ``subs`` of its units, in its own format."""
    k, s = kind(m), f"{subs}[0]"
    same = f"array_join(transform(sequence(1, length({m})), i -> CASE WHEN substr({m}, i, 1) RLIKE '[A-Z]' THEN upper(substr({s}, i, 1)) ELSE substr({s}, i, 1) END), '')"
    spread = (f"array_join(transform(sequence(1, length({m})), i -> CASE WHEN substr({m}, i, 1) RLIKE '[0-9A-Za-z+]' THEN "
              f"CASE WHEN substr({m}, i, 1) RLIKE '[A-Z]' THEN upper(substr({s}, length(regexp_replace(left({m}, i), '[^0-9A-Za-z+]', '')), 1)) "
              f"ELSE substr({s}, length(regexp_replace(left({m}, i), '[^0-9A-Za-z+]', '')), 1) END ELSE substr({m}, i, 1) END), '')")
    parts = _parts(m)
    name = (f"concat_ws(' ', split({m}, ' ')[0], array_join(zip_with({parts}, {subs}, (t, n) -> {_in_form('t', 'n')}), ' '))")
    return f"CASE {k} WHEN 'name' THEN {name} WHEN 'ip' THEN {s} WHEN 'email' THEN {same} WHEN 'secret' THEN {same} ELSE {spread} END"


DRAWN = 4096  # entities that a task draws surrogates for
CLASHES = 16  # draws that a kind takes to find one whose surrogates are no entities of the corpus


def first_draw(kind_: str, entities: int) -> int:
    """The draw that names start with: enough syllables that a collision is unlikely among so many."""
    n = 1
    while kind_.startswith(("given", "family")) and 70 ** n < 8 * entities ** 2:
        n += 1
    return 4 * (n - 1)


def draws(rows: DataFrame, key: str = KEY) -> dict[str, int]:
    """The draw of each kind (see ``space``) in which no two distinct entities of ``rows._hits`` share a surrogate and,
    if one of the first ``CLASHES`` draws does so, none is itself an entity of the corpus; otherwise that with
    fewest such clashes. The table of distinct entities is written; the driver sees one row a kind and draw."""
    found = rows.select(F.explode("_hits").alias("m")).distinct().select(F.explode(F.expr(units("m"))).alias("u")).select("u.kind", "u.canon").filter("kind <> 'particle'")
    found = written(found.select(F.expr(space("kind")).alias("kind"), "canon").distinct(), "entities")
    start = {r["kind"]: r["count"] for r in found.groupBy("kind").count().collect()}
    found = found.repartition(1 + sum(start.values()) // DRAWN, "kind", "canon")
    start = {k: first_draw(k, n) for k, n in start.items()}
    best: dict[str, tuple[int, int, int]] = {}
    tried, more = 0, 1
    while True:
        open_ = [k for k in start if k not in best or best[k][0] or (best[k][1] and tried < CLASHES)]
        if not open_:
            return {k: turn for k, (_, _, turn) in best.items()}
        first = "CASE kind " + " ".join(f"WHEN '{k}' THEN {start[k] + tried}" for k in open_) + " END"
        drawn = found.filter(F.col("kind").isin(open_)).withColumn("turn", F.explode(F.expr(f"sequence({first}, {first} + {more - 1})")))
        # a given name has a form for each gender
        forms = "CASE WHEN kind LIKE 'given%' THEN transform(array('f', 'm'), g -> concat('given_', g, substr(kind, 6))) ELSE array(kind) END"
        drawn = drawn.withColumn("form", F.explode(F.expr(forms))).withColumn("s", F.expr(surrogate("form", "canon", "turn", key)))
        twice = drawn.groupBy("kind", "turn", "form", "s").agg((F.count(F.lit(1)) - 1).alias("twice")).filter("twice > 0").groupBy("kind", "turn").agg(F.sum("twice").alias("twice"))
        real = found.select(F.col("kind").alias("_k"), F.col("canon").alias("_s"))
        clash = drawn.join(real, (F.col("kind") == F.col("_k")) & (F.col("s") == F.col("_s")), "left_semi").groupBy("kind", "turn").agg(F.count(F.lit(1)).alias("clash"))
        bad = {(r["kind"], r["turn"]): (r["twice"] or 0, r["clash"] or 0) for r in twice.join(clash, ["kind", "turn"], "full").collect()}
        for k in open_:
            for turn in range(start[k] + tried, start[k] + tried + more):
                best[k] = min(best.get(k, (2 ** 62, 0, 0)), (*bad.get((k, turn), (0, 0)), turn))
        tried, more = tried + more, more * 4


def replace_entities(docs: DataFrame, text_col: str = "text", key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in its text column, and as a last column ``_hits`` (the mentions, in order)."""
    names, text_col = docs.columns, place_of(docs, text_col)
    docs = masked(docs)
    rows = docs.withColumn("_hits", F.expr(mentions(f"`{text_col}`")))
    # mentions are few and short: they alone are shuffled, to the table of entities; texts stay where they are
    held = written(rows.select("_hits").filter(F.size("_hits") > 0), "mentions")
    chosen = draws(held, key)
    turn = f"CASE {space('u.kind')} " + "".join(f"WHEN '{k}' THEN {t} " for k, t in sorted(chosen.items())) + "ELSE 0 END" if chosen else "0"
    # a lambda's value is used many times over, so each step is a list of its own
    rows = rows.withColumn("_units", F.expr(f"transform(_hits, m -> {units('m')})"))
    rows = rows.withColumn("_units", F.expr(resolved("_units")))
    rows = rows.withColumn("_subs", F.expr(f"transform(_units, one -> transform(one, u -> {surrogate('u.kind', 'u.canon', f'({turn})', key)}))"))
    rows = rows.withColumn("_new", F.expr(f"zip_with(_hits, _subs, (m, s) -> {rendered('m', 's')})"))
    pieces = f"split(`{text_col}`, {_lit(PATTERN)}, -1)"
    # untitled mentions of the names' parts, between the mentions found
    pairs = (f"flatten(zip_with(_hits, _subs, (m, s) -> CASE WHEN {kind('m')} = 'name' THEN zip_with({_parts('m')}, s, (t, n) -> struct(t AS t, {_in_form('t', 'n')} AS n)) ELSE array() END))")
    rows = rows.withColumn("_bare", F.expr(f"filter(array_distinct({pairs}), p -> p.t RLIKE {_lit(r"^\p{Lu}[\p{L}'’-]{2,}$")})"))
    bare = f"regexp_replace(a, concat({_lit(r"(?<![\p{L}\p{N}_-])")}, p.t, {_lit(r"(?![\p{L}\p{N}_-])")}), p.n)"
    pieces = f"CASE WHEN size(_bare) > 0 THEN transform({pieces}, x -> aggregate(_bare, x, (a, p) -> {bare})) ELSE {pieces} END"
    done = F.expr(f"CASE WHEN size(_hits) > 0 THEN array_join(zip_with({pieces}, _new, (a, b) -> concat(a, coalesce(b, ''))), '') ELSE `{text_col}` END")
    return rows.withColumn(text_col, done).select(*docs.columns, "_hits").toDF(*names, "_hits")


def _kinds(hits: Column | str) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.expr(f"transform({hits}, m -> {kind('m')})"))), ",")


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates for its personal data, how many mentions, and their kinds."""
    r = replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return r.select("doc_id", "text", F.coalesce(F.size("_hits"), F.lit(0)).cast("long").alias("n_replaced"), _kinds("_hits").alias("kinds"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all rows and columns; texts with surrogates, ``n_chars`` as they then are."""
    r = masked(replace_entities(docs))
    cols = r.columns[:-1]  # without the mentions
    if "n_chars" in docs.columns:
        n = place_of(docs, "n_chars")
        r = r.withColumn(n, F.length(place_of(docs, "text")).cast(docs.schema["n_chars"].dataType))
    return r.select(*cols).toDF(*docs.columns)
