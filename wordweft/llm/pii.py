"""Format-preserving pseudonyms for personal data.

Numbers and dates are found by their form, validated (check digit, octet range, calendar), and replaced by a
keyed permutation of the same format: a Feistel network over the symbols of the value. Equal values get equal
pseudonyms in all documents, different values different ones, and whoever has the key can go back.

=========  ===========================================  ========================================
kind       what is found                                what changes
=========  ===========================================  ========================================
email      address                                      letters and digits of the local part
secret     32 or more hexadecimal digits                all digits
date       yyyy-mm-dd that exists, 1800 to 2199         the day, within 1800-01-01 + 146,000 days
ip         four numbers of at most 255                  all 32 bits
phone      +c (ddd) ddd-dddd, (ddd) ddd-dddd,           the ten national digits
           ddd-ddd-dddd
card       13 to 19 digits, single spaces or dashes     all digits; the check digit is made anew
           between, with a right check digit
=========  ===========================================  ========================================

A value that fails its validation is left as it is. Texts without a digit or an at-sign are not searched.

Cards stand beside other numbers. Digit groups with single spaces or dashes between are taken as one run, which
ends before an address, date or phone number. In a run, first the layouts of cards are looked for at each group
(unbroken, 4-4-4-4, 4-6-5, 4-6-4, 4-4-4-4-3), then in what is left the longest start and any other whole groups of
three or more digits. Each candidate has its check digit tested; one that fails hides nothing behind it.

Nulls: a null text is empty; it and an empty text come out empty. Repeated rows are treated alike. An empty
table gives no rows. Extra columns are ignored by ``pseudonyms``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_text

KEY, ROUNDS = "change-me", 8
DAYS, FIRST_DAY, YEARS = 365, "1800-01-01", 400
_DIGITS, _LETTERS, _HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"

KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": r"(?<![0-9A-Za-z])[0-9a-fA-F]{32,}+(?![0-9A-Za-z])",
    "date": r"(?<!\d)(?<!\d-)\d{4}-\d{2}-\d{2}(?!-?\d)",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)",
    "phone": r"(?<![\d(])(?:\+\d{1,3} )?(?:\(\d{3}\) |\d{3}-)\d{3}-\d{4}(?!-?\d)",
}
#: A run of digit groups that may hold cards; it ends before whatever {stop} matches.
RUN = r"(?<!\d)(?=\d(?:[ -]?\d){12})\d{1,19}+(?!\d)(?:[ -](?!{stop})\d{1,19}+(?!\d))*+"
KINDS["card"] = RUN.replace("{stop}", "|".join(KINDS[k] for k in ("email", "date", "ip", "phone")))
#: Layouts of cards, and other groupings: the longest start of what is left, then whole groups, longest first.
LAYOUTS = [r"\d{13,19}", r"\d{4}(?: \d{4}){3}|\d{4}(?:-\d{4}){3}", r"\d{4} \d{6} \d{4,5}|\d{4}-\d{6}-\d{4,5}",
           r"\d{4}(?: \d{4}){3} \d{3}|\d{4}(?:-\d{4}){3}-\d{3}"]
GROUPINGS = [r"(?<!\d[ -])\d(?:[ -]?\d){12,18}", *[
    rf"\d{{3}}(?:(?:(?<=\d{{3}})[ -](?=\d{{3}}))?\d){{{n - 3}}}" for n in range(19, 12, -1)]]


def _add(value: str, other: str, alphabet: str, label: str) -> str:
    """SQL: each symbol of ``value`` moved by a digit that the key, the round and the other half decide."""
    stream = f"sha2(concat_ws('|', '{{key}}', '{label}', i, length({value}), {other}), 512)"
    place = "(4 * ((p - 1) % 32) + 1)"
    move = f"cast(conv(substring(stream, {place}, 4), 16, 10) as bigint)"
    symbol = f"locate(substring({value}, p, 1), '{alphabet}') - 1"
    moved = f"substring('{alphabet}', cast(({symbol} + {move}) % {len(alphabet)} + 1 as int), 1)"
    # The stream is computed once per half: it travels as the only item of an array.
    return (f"element_at(transform(array({stream}), stream -> if(length({value}) = 0, '', array_join(transform("
            f"sequence(1, greatest(1, length({value}))), p -> {moved}), ''))), 1)")


def feistel(x: str, alphabet: str, label: str) -> str:
    """SQL: keyed permutation of the strings of x's length over the alphabet."""
    half = f"cast(floor(length({x}) / 2) as int)"
    left, right = _add("s.l", "s.r", alphabet, label), _add("s.r", "s.l", alphabet, label)
    return (f"aggregate(sequence(0, {ROUNDS - 1}), named_struct('l', substring({x}, 1, {half}), 'r', substring({x}, {half} + 1)), "
            f"(s, i) -> if(i % 2 = 0, named_struct('l', {left}, 'r', s.r), named_struct('l', s.l, 'r', {right})), "
            f"s -> concat(s.l, s.r))")


def _let(value: str, name: str, body: str) -> str:
    """SQL: ``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _refill(form: str, symbols: str, chars: str) -> str:
    """SQL: ``form`` with its characters of the class replaced, in order, by ``symbols``; upper case stays."""
    count = f"length(regexp_replace(substring({form}, 1, q), '[^{chars}]', ''))"
    new = f"substring({symbols}, {count}, 1)"
    char = f"substring({form}, q, 1)"
    return (f"array_join(transform(sequence(1, length({form})), q -> if({char} rlike '[{chars}]', "
            f"if({char} rlike '[A-Z]', upper({new}), {new}), {char})), '')")


def _luhn_sum(digits: str, doubled: int) -> str:
    """SQL: the weighted digit sum; places of parity ``doubled``, counted from the right from 0, are doubled."""
    d = f"cast(substring({digits}, length({digits}) - k, 1) as int)"
    twice = f"if({d} > 4, 2 * {d} - 9, 2 * {d})"
    return f"aggregate(sequence(0, length({digits}) - 1), 0, (a, k) -> a + if(k % 2 = {doubled}, {twice}, {d}))"


def _only(x: str, chars: str) -> str:
    return f"regexp_replace({x}, '[^{chars}]', '')"


def _cut_cards(x: str, layouts: list[str]) -> str:
    """SQL: ``x`` cut into an array of (card, text); at each digit group the first layout with a right check digit counts."""
    found = ", ".join(rf"regexp_extract_all({x}, r'(?<!\d)(?=((?:{p})(?!\d)|))(?=\d)', 1)" for p in layouts)
    right = f"{_let(_only('y', '0-9'), 'z', _luhn_sum('z', 1))} % 10 = 0"
    hit = f"coalesce(get(filter(transform(c, f -> f[i - 1]), y -> y != '' and {right}), 0), '')"
    last = r"i + size(regexp_extract_all(hit, r'\d+', 0)) - 1"
    piece = "array(named_struct('card', %s, 'text', %s))"
    step = (f"named_struct('out', concat(s.out, {piece % ('false', 's.plain')}, {piece % ('true', 'hit')}), "
            rf"'plain', regexp_extract(g[{last} - 1], r'\D*$', 0), 'past', {last})")
    on = "named_struct('out', s.out, 'plain', concat(s.plain, g[i - 1]), 'past', s.past)"
    start = rf"named_struct('out', cast(array() as array<struct<card:boolean,text:string>>), 'plain', regexp_extract({x}, r'^\D*', 0), 'past', 0)"
    cut = (f"aggregate(sequence(1, size(g)), {start}, (s, i) -> if(i <= s.past, s, {_let(hit, 'hit', f'if(hit = {chr(39) * 2}, {on}, {step})')}), "
           f"s -> concat(s.out, {piece % ('false', 's.plain')}))")
    groups = rf"regexp_extract_all({x}, r'\d+\D*', 0)"
    return _let(groups, "g", f"if(size(g) = 0, {piece % ('false', x)}, {_let(f'array({found})', 'c', cut)})")


def _rules() -> dict[str, tuple[str, str]]:
    """Kind -> (SQL validation, SQL replacement) of a match ``m``."""
    digits = _only("m", "0-9")
    local, domain = "substring_index(m, '@', 1)", "substring_index(m, '@', -1)"
    letters = _let(feistel(f"lower({_only(local, 'A-Za-z')})", _LETTERS, "letters"), "w", _refill(local, "w", "A-Za-z"))
    numbers = _let(feistel(_only("u", "0-9"), _DIGITS, "digits"), "w", _refill("u", "w", "0-9"))
    day = f"datediff(to_date(m), date'{FIRST_DAY}')"
    roll = "cast(conv(substring(sha2(concat_ws('|', '{key}', 'date', i, %s), 256), 1, 12), 16, 10) as bigint)"
    dated = (
        f"aggregate(sequence(0, {ROUNDS - 1}), named_struct('y', cast(floor(n / {DAYS}) as bigint), 'd', cast(n % {DAYS} as bigint)), "
        f"(s, i) -> if(i % 2 = 0, named_struct('y', (s.y + {roll % 's.d'}) % {YEARS}, 'd', s.d), "
        f"named_struct('y', s.y, 'd', (s.d + {roll % 's.y'}) % {DAYS})), "
        f"s -> cast(date_add(date'{FIRST_DAY}', cast(s.y * {DAYS} + s.d as int)) as string))")
    octets = "split(m, '[.]')"
    bits = f"array_join(transform({octets}, o -> lpad(lower(conv(o, 10, 16)), 2, '0')), '')"
    back = "array_join(transform(array(1, 3, 5, 7), k -> conv(substring(w, k, 2), 16, 10)), '.')"
    national = _let(feistel("right(d, 10)", _DIGITS, "phone"), "w", _refill("m", "concat(left(d, length(d) - 10), w)", "0-9"))
    card = _let(feistel("left(d, length(d) - 1)", _DIGITS, "card"), "w", _refill(
        "m", f"concat(w, cast((10 - {_luhn_sum('w', 0)} % 10) % 10 as string))", "0-9"))
    return {
        "email": ("true", f"concat({_let(letters, 'u', numbers)}, '@', {domain})"),
        "secret": ("true", _let(feistel("lower(m)", _HEX, "secret"), "w", _refill("m", "w", "0-9A-Fa-f"))),
        "date": (f"coalesce({day.replace('to_date(m)', 'try_to_date(m)')} between 0 and {DAYS * YEARS - 1}, false)",
                 _let(day, "n", dated)),
        "ip": (f"forall({octets}, o -> cast(o as int) <= 255 and (o = '0' or o not like '0%'))",
               _let(feistel(bits, _HEX, "ip"), "w", back)),
        "phone": ("true", _let(digits, "d", national)),
        "card": ("true", _let(digits, "d", card)),
    }


def _first_kind(kinds: dict[str, str], m: str) -> dict[str, str]:
    """SQL tests of which kind a match is, by the form of the whole match."""
    form = {"email": f"contains({m}, '@')", "secret": f"{m} rlike '^[0-9a-fA-F]{{32,}}$'", "date": f"{m} rlike '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$'",
            "ip": f"contains({m}, '.')", "phone": f"{m} rlike '^([+]|[(]|[0-9]{{3}}-[0-9]{{3}}-[0-9]{{4}}$)'", "card": "true"}
    return {k: form[k] for k in kinds}


def pseudonyms(docs: DataFrame, key: str = KEY, kinds=tuple(KINDS)) -> DataFrame:
    """doc_id, text (with pseudonyms), n_found, and n_<kind> for each kind."""
    if "'" in key or "{" in key or "\\" in key:
        raise ValueError("the key must not contain quotes, braces or backslashes")
    rules, tests = _rules(), _first_kind({k: KINDS[k] for k in kinds}, "m")
    pattern = "|".join(KINDS[k] for k in kinds)
    one = lambda k: (f"if({rules[k][0]}, named_struct('kind', '{k}', 'text', {rules[k][1]}, 'n', 1), "  # noqa: E731
                     "named_struct('kind', '', 'text', m, 'n', 0))")
    cuts = _let(_cut_cards("m", LAYOUTS), "first", f"flatten(transform(first, b -> if(b.card, array(b), {_let('b.text', 'rest', _cut_cards('rest', GROUPINGS))})))")
    text = f"array_join(transform(cuts, b -> if(b.card, {_let('b.text', 'm', rules['card'][1])}, b.text)), '')"
    run = _let(cuts, "cuts", f"named_struct('kind', 'card', 'text', {text}, 'n', size(filter(cuts, b -> b.card)))")
    cases = " ".join(f"when {tests[k]} then {run if k == 'card' else one(k)}" for k in kinds)
    replaced = F.expr(f"transform(found, m -> case {cases} end)".replace("{key}", key))
    searched = F.col("text").rlike("[0-9@]")
    pieces = (
        doc_text(docs)
        .withColumn("found", F.when(searched, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
        .withColumn("gaps", F.when(F.size("found") > 0, F.split("text", pattern, -1)).otherwise(F.array("text")))
        .withColumn("new", replaced)
    )
    joined = F.array_join(F.zip_with("gaps", "new", lambda g, n: F.concat(g, F.coalesce(n["text"], F.lit("")))), "")
    total = lambda found: F.aggregate(found, F.lit(0).cast("bigint"), lambda a, n: a + n["n"])
    count = lambda k: total(F.filter("new", lambda n: n["kind"] == k))
    return pieces.select(
        "doc_id", joined.alias("text"), total(F.col("new")).alias("n_found"),
        *[count(k).alias(f"n_{k}") for k in kinds])
