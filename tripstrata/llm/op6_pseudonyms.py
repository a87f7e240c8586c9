"""Format-preserving pseudonyms for private data, as DataFrame expressions only.

One pattern finds candidates; each is validated (Luhn sum, calendar, ranges) and replaced by a keyed permutation of its
own format, so that equal values get equal pseudonyms in all documents and different values different ones. Numbers and
dates are a pair (a, b) from [0, A) x [0, B), permuted by a Feistel network whose rounds add a keyed hash of one half to the
other, modulo its size. E-mail names and secrets are two strings; a round moves each letter or digit of one half within its class
by a keyed stream made from the other. Every round can be undone with the key, which makes the whole a permutation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The formats looked for, in this order at one place.
FORMATS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24}",
    "secret": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])|(?i:password|passwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?[^\s\"']{8,}",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)",
    "date": r"(?<!\d)\d{4}-\d{2}-\d{2}(?!\d)|(?<![\d./])\d{1,2}([./])\d{1,2}\1\d{4}(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d+])(?:\+?1[ .-]?)?(?:\([2-9]\d{2}\) ?|[2-9]\d{2}[ .-])[2-9]\d{2}[ .-]\d{4}(?!\d)",
}
#: Groups of digits, 13 or more together, up to where a format with other marks starts. Cards lie between limits of groups.
_EXTENDED = "|".join(f"(?:{FORMATS[k]})" for k in ("email", "ip", "date")).replace(r"([./])\d{1,2}\1", r"(?:\.\d{1,2}\.|/\d{1,2}/)")
FORMATS["card"] = rf"(?<!\d)(?=\d(?:[ -]?\d){{12}})\d++(?:[ -](?!{_EXTENDED})\d++)*+"
KINDS = tuple(FORMATS)
#: How cards are usually written, and the formats that may follow one in the same run of groups.
USUAL_CARD = r"^(?:\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}(?:\1\d{1,3})?|\d{4}([ -])\d{6}\2\d{4,5}|\d{13,19})$"
_IN_RUN = rf"^.(\d{{4}}-\d{{2}}-\d{{2}}(?!\d)|(?:{FORMATS['ssn']})|(?:{FORMATS['phone']}))"
ROUNDS = 10
#: Days from 1900-01-01 on that count as dates; 340 * 215 of them.
DAYS = (340, 215)

#: Every format holds one of these, so texts without them need no search.
_HINT = "[0-9@=:]|AKIA"
_ANY = "|".join(f"(?:{p})" for p in FORMATS.values()).replace(r"([./])\d{1,2}\1", r"(?:\.\d{1,2}\.|/\d{1,2}/)")


def _hash(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *(p.cast("string") for p in parts)), 256)


def _number(hashed: Column) -> Column:
    return F.conv(F.substring(hashed, 1, 15), 16, 10).cast("bigint")


def feistel(key: str, kind: Column, a: Column, b: Column, size_a: Column, size_b: Column, back: bool = False) -> Column:
    """The pair (a, b) permuted within [0, size_a) x [0, size_b), as a struct; `back` undoes it."""
    sign = F.lit(-1 if back else 1)

    def step(s: Column, r: Column) -> Column:
        move = lambda x, other, size: F.pmod(x + sign * F.pmod(_number(_hash(key, kind, r, other)), size), size)
        odd = r % 2 == 1
        return F.struct(F.when(odd, move(s["a"], s["b"], size_a)).otherwise(s["a"]).alias("a"), F.when(odd, s["b"]).otherwise(move(s["b"], s["a"], size_b)).alias("b"))

    order = range(ROUNDS, 0, -1) if back else range(1, ROUNDS + 1)
    return F.aggregate(F.array(*map(F.lit, order)), F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b")), step)


_CLASSES = (("0123456789", "[0-9]"), ("abcdefghijklmnopqrstuvwxyz", "[a-z]"), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "[A-Z]"))


def _shifted(text: Column, stream: Column, sign: int) -> Column:
    """Each ASCII letter or digit of the text moved within its class by the stream's bytes (hex, used in a circle)."""

    def moved(c: Column, i: Column) -> Column:
        by = F.conv(F.substr(stream, F.pmod(i, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        out = c
        for letters, pattern in _CLASSES:
            to = F.substr(F.lit(letters), F.pmod(F.instr(F.lit(letters), c) - 1 + sign * by, F.lit(len(letters))) + 1, F.lit(1))
            out = F.when(c.rlike(pattern), to).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(text, ""), moved), "")


def string_feistel(key: str, kind: Column, text: Column, back: bool = False) -> Column:
    """A string of the same letter classes. Of two halves, each round moves one by a stream made from the other."""
    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substr(text, F.lit(1), half).alias("a"), F.substr(text, half + 1).alias("b"))
    sign = -1 if back else 1

    def step(s: Column, r: Column) -> Column:
        odd = r % 2 == 1
        return F.struct(
            F.when(odd, _shifted(s["a"], _hash(key, kind, r, s["b"]), sign)).otherwise(s["a"]).alias("a"),
            F.when(odd, s["b"]).otherwise(_shifted(s["b"], _hash(key, kind, r, s["a"]), sign)).alias("b"),
        )

    order = range(ROUNDS, 0, -1) if back else range(1, ROUNDS + 1)
    return F.aggregate(F.array(*map(F.lit, order)), start, step, lambda s: F.concat(s["a"], s["b"]))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refilled(text: Column, digits: Column) -> Column:
    """The text with its digits, in order, replaced by `digits`."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))

    def step(s: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        return F.struct(F.concat(s["out"], F.when(digit, F.substr(digits, s["k"], F.lit(1))).otherwise(c)).alias("out"), F.when(digit, s["k"] + 1).otherwise(s["k"]).alias("k"))

    return F.aggregate(F.split(text, ""), start, step, lambda s: s["out"])


def _luhn(digits: Column) -> Column:
    """The Luhn sum, doubling every second digit from the right."""
    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 0, d * 2).otherwise(d)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _padded(x: Column, width: Column | int) -> Column:
    return F.lpad(x.cast("string"), width, "0") if isinstance(width, int) else F.expr("NULL")


def _card(key: str, m: Column, back: bool) -> Column:
    digits = _digits(m)
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    power = lambda n: F.expr("1") * F.pow(F.lit(10.0), n).cast("bigint")
    left, right = F.floor(F.length(body) / 2).cast("int"), F.length(body) - F.floor(F.length(body) / 2).cast("int")
    a, b = F.substr(body, F.lit(1), left).cast("bigint"), F.substr(body, left + 1).cast("bigint")

    def fill(p: Column) -> Column:
        zeros = "0" * 20
        to = F.concat(F.right(F.concat(F.lit(zeros), p["a"].cast("string")), left), F.right(F.concat(F.lit(zeros), p["b"].cast("string")), right))
        check = F.pmod(10 - F.pmod(_luhn(F.concat(to, F.lit("0"))), F.lit(10)), F.lit(10))
        return _refilled(m, F.concat(to, check.cast("string")))

    new = F.element_at(F.transform(F.array(feistel(key, F.concat(F.lit("card"), F.length(body).cast("string")), a, b, power(left), power(right), back)), fill), 1)
    return F.when(F.length(digits).between(13, 19) & (F.pmod(_luhn(digits), F.lit(10)) == 0), new)


def _in_run(run: Column) -> Column:
    """The run of digit groups cut into cards, dates, social security numbers, phones and what is between them.

    Usual card groupings go first, wherever they start; a looser card may not reach into one. What is no card is tried for
    the other formats, group by group.
    """
    most = 19
    text = lambda g, i, n: F.regexp_replace(F.array_join(F.slice(g, i, n), ""), "[ -]$", "")
    # Each step's value is bound by a transform of one element, so that it is taken once.
    bound = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))
    right = lambda part: F.length(_digits(part)).between(13, most) & (F.pmod(_luhn(_digits(part)), F.lit(10)) == 0)

    def starting(g: Column, sizes: Column, i: Column) -> Column:
        """Numbers of groups from i on that make a card: `usual`, the longest written as usual or 0, and `loose`, all."""
        digits = lambda n: F.aggregate(F.slice(sizes, i, n), F.lit(0), lambda x, y: x + y)
        fitting = F.filter(F.sequence(F.lit(1), F.least(F.lit(most), F.size(g) - i + 1)), lambda n: digits(n).between(13, most))
        good = F.filter(F.transform(fitting, lambda n: F.struct(n.alias("n"), text(g, i, n).alias("part"))), lambda p: right(p["part"]))
        longest = lambda x: F.coalesce(F.array_max(F.transform(x, lambda p: p["n"])), F.lit(0))
        return bound(good, lambda x: F.struct(longest(F.filter(x, lambda p: p["part"].rlike(USUAL_CARD))).alias("usual"), F.transform(x, lambda p: p["n"]).alias("loose")))

    def walk(n: Column, first: Column, kind: str, step: Callable[[Column, Column], Column]) -> Column:
        """What `step` emits from 1 to n in order; it gets what it carries and the place, and gives `carry` and `out`.

        Arrays grow by copying, so blocks of about the root of n places are gathered first, then the blocks.
        """
        block = F.greatest(F.lit(32), F.ceil(F.sqrt(n)).cast("int"))
        none = F.array().cast(f"array<{kind}>")
        start = lambda carry, out: F.struct(carry.cast("int").alias("carry"), out.alias("out"))
        add = lambda s, i: bound(step(s["carry"], i), lambda r: start(r["carry"], F.concat(s["out"], r["out"])))
        inner = lambda carry, lo: F.aggregate(F.sequence(lo, F.least(lo + block - 1, n)), start(carry, none), add)
        outer = lambda s, lo: bound(inner(s["carry"], lo), lambda r: start(r["carry"], F.array_append(s["out"], r["out"])))
        return F.aggregate(F.sequence(F.lit(1), n, block), start(first, F.array().cast(f"array<array<{kind}>>")), outer, lambda s: F.flatten(s["out"]))

    def apart(cards: Column) -> Column:
        """For each group, how many groups the usual card has that starts there, without those that start inside another."""
        def step(left: Column, i: Column) -> Column:
            n = F.when(left > 0, 0).otherwise(F.get(cards, i - 1)["usual"]).cast("int")
            return F.struct((F.greatest(left, n, F.lit(1)) - 1).alias("carry"), F.array(n).alias("out"))

        return walk(F.size(cards), F.lit(0), "int", step)

    def cut(g: Column, cards: Column, usual: Column) -> Column:
        def step(at: Column, i: Column) -> Column:
            room = F.coalesce(F.array_min(F.filter(F.sequence(F.lit(0), F.lit(most)), lambda k: F.coalesce(F.get(usual, i - 1 + k), F.lit(0)) > 0)), F.lit(most))
            card = lambda room: F.when(room == 0, F.get(usual, i - 1)).otherwise(F.array_max(F.filter(F.get(cards, i - 1)["loose"], lambda n: n <= room)))
            other = F.when(i > 1, F.regexp_extract(F.concat(F.right(F.get(g, i - 2), F.lit(1)), F.array_join(F.slice(g, i, 8), "")), _IN_RUN, 1))
            groups_of = lambda x, room: F.when((F.length(x) > 0) & (F.size(F.split(x, "[ -]")) <= room), F.size(F.split(x, "[ -]")))
            size = bound(room, lambda r: F.coalesce(card(r), groups_of(other, r), F.lit(1)))

            def add(n: Column) -> Column:
                mark = F.regexp_extract(F.get(g, i + n - 2), "[ -]?$", 0)
                return F.struct((i + n).cast("int").alias("carry"), F.array(text(g, i, n), mark).alias("out"))

            return F.when(i >= at, bound(size, add)).otherwise(F.struct(at.cast("int").alias("carry"), F.array().cast("array<string>").alias("out")))

        return walk(F.size(g), F.lit(1), "string", step)

    groups = F.regexp_extract_all(run, F.lit(r"(\d+[ -]?)"), F.lit(1))
    sizes = lambda g: F.transform(g, lambda x: F.length(_digits(x)))
    every = lambda g: bound(sizes(g), lambda n: F.transform(F.sequence(F.lit(1), F.size(g)), lambda i: starting(g, n, i)))
    return bound(groups, lambda g: bound(every(g), lambda cards: bound(apart(cards), lambda usual: cut(g, cards, usual))))


def _phone(key: str, m: Column, back: bool) -> Column:
    digits = F.right(_digits(m), F.lit(10))
    a, rest = F.substr(digits, F.lit(1), F.lit(3)).cast("bigint") - 200, (F.substr(digits, F.lit(4), F.lit(3)).cast("bigint") - 200) * 10_000 + F.substr(digits, F.lit(7)).cast("bigint")
    country = F.substr(_digits(m), F.lit(1), F.length(_digits(m)) - 10)

    def fill(p: Column) -> Column:
        return _refilled(m, F.concat(country, (p["a"] + 200).cast("string"), (F.floor(p["b"] / 10_000) + 200).cast("string"), _padded(F.pmod(p["b"], F.lit(10_000)), 4)))

    return F.element_at(F.transform(F.array(feistel(key, F.lit("phone"), a, rest, F.lit(800), F.lit(8_000_000), back)), fill), 1)


def _ssn(key: str, m: Column, back: bool) -> Column:
    area, group, serial = (F.substr(m, F.lit(i), F.lit(n)).cast("bigint") for i, n in ((1, 3), (5, 2), (8, 4)))
    good = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - 1 - F.when(area > 666, 1).otherwise(0)

    def fill(p: Column) -> Column:
        area = p["a"] + 1 + F.when(p["a"] >= 665, 1).otherwise(0)
        return F.concat_ws("-", _padded(area, 3), _padded(F.floor(p["b"] / 9_999) + 1, 2), _padded(F.pmod(p["b"], F.lit(9_999)) + 1, 4))

    return F.when(good, F.element_at(F.transform(F.array(feistel(key, F.lit("ssn"), place, (group - 1) * 9_999 + serial - 1, F.lit(898), F.lit(99 * 9_999), back)), fill), 1))


def _ip(key: str, m: Column, back: bool) -> Column:
    octet = [F.get(F.split(m, r"\."), F.lit(i)).cast("bigint") for i in range(4)]
    good = (octet[0] < 256) & (octet[1] < 256) & (octet[2] < 256) & (octet[3] < 256)

    def fill(p: Column) -> Column:
        return F.concat_ws(".", *(x.cast("string") for h in ("a", "b") for x in (F.floor(p[h] / 256), F.pmod(p[h], F.lit(256)))))

    return F.when(good, F.element_at(F.transform(F.array(feistel(key, F.lit("ip"), octet[0] * 256 + octet[1], octet[2] * 256 + octet[3], F.lit(65_536), F.lit(65_536), back)), fill), 1))


def _date(key: str, m: Column, back: bool) -> Column:
    iso = m.rlike("^[0-9]{4}-")
    part = F.split(m, "[./-]")
    first, second, third = (F.get(part, F.lit(i)) for i in range(3))
    # With slashes the month comes first, or the day if that is no date; with points the day.
    slash = F.contains(m, F.lit("/"))
    year, month, day = F.when(iso, first).otherwise(third), F.when(iso | ~slash, second).otherwise(first), F.when(iso, third).when(slash, second).otherwise(first)
    days = lambda y, m, d: F.datediff(F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd"), F.lit("1900-01-01").cast("date"))
    at, swapped = days(year, month, day), F.when(slash, days(third, second, first))
    dated = lambda p: F.date_add(F.lit("1900-01-01").cast("date"), (p["a"] * DAYS[1] + p["b"]).cast("int"))

    def pair(kind: str, a: Column, b: Column) -> Column:
        return feistel(key, F.lit(kind), a, b, F.lit(DAYS[0]), F.lit(DAYS[1]), back)

    def fill(p: Column) -> Column:
        date = dated(p)
        return F.when(iso, F.date_format(date, "yyyy-MM-dd")).when(slash, F.date_format(date, "MM/dd/yyyy")).otherwise(F.date_format(date, "dd.MM.yyyy"))

    def again(p: Column, i: Column) -> Column:
        # A day up to 12 would be read as a month, so the walk goes on until the day is above; 2 of 5 steps miss.
        return F.when((i == 0) | (F.dayofmonth(dated(p)) <= 12), pair("day-first date", p["a"], p["b"])).otherwise(p)

    halves = lambda x: (F.floor(x / DAYS[1]), F.pmod(x, F.lit(DAYS[1])))
    new = F.element_at(F.transform(F.array(pair("date", *halves(at))), fill), 1)
    a, b = halves(swapped)
    walked = F.aggregate(F.sequence(F.lit(0), F.lit(60)), F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b")), again, lambda p: F.date_format(dated(p), "dd/MM/yyyy"))
    inside = lambda x: x.between(0, DAYS[0] * DAYS[1] - 1)
    return F.when(inside(at), new).when(at.isNull() & inside(swapped), walked)


def _email(key: str, m: Column, back: bool) -> Column:
    name, host = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    return F.concat(string_feistel(key, F.concat(F.lit("email"), host), name, back), F.lit("@"), host)


def _secret(key: str, m: Column, back: bool) -> Column:
    value = F.regexp_extract(m, r"^(AKIA|[A-Za-z_-]+\s*[=:]\s*[\"']?)(.*)$", 2)
    return F.concat(F.substr(m, F.lit(1), F.length(m) - F.length(value)), string_feistel(key, F.lit("secret"), value, back))


_MAKERS: dict[str, Callable[[str, Column, bool], Column]] = {"email": _email, "secret": _secret, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}
#: What tells a found candidate's kind, tried in this order.
_TELLS = {
    "secret": r"^AKIA|^(?i:password|passwd|secret|token|api[_-]?key)\s*[=:]", "email": "@", "ip": r"^\d{1,3}(\.\d{1,3}){3}$", "date": r"^\d{4}-\d{2}-\d{2}$|^\d{1,2}([./])\d{1,2}\1\d{4}$",
    "ssn": r"^\d{3}-\d{2}-\d{4}$", "phone": r"^(\+?1[ .-]?)?(\([2-9]\d{2}\) ?|[2-9]\d{2}[ .-])[2-9]\d{2}[ .-]\d{4}$", "card": r"^\d",
}


def pseudonymized(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", back: bool = False) -> DataFrame:
    """doc_id, text with pseudonyms, n_found, and n_<kind> for each kind, one row per input row, without a shuffle.

    Candidates that fail validation stay as they are and aren't counted. A null text stays null with counts 0. Null or repeated
    ids and repeated rows keep their rows; other columns are not read. `back` turns pseudonyms into the values they stand for,
    where the same candidates are found again. Dates outside 1900-01-01 to 2100-02-20 are not taken for dates; slashes put
    the month first, or the day where that gives no date, points the day. Cards are looked for in runs of digit groups, of 13 to 19 digits between limits of groups. The key is part of the query's plan: redact plans and event logs accordingly.
    """
    text = F.col(text_col).cast("string")
    found = F.when(text.rlike(_HINT), F.regexp_extract_all(text, F.lit(_ANY), F.lit(0)))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), F.coalesce(found, F.array().cast("array<string>")).alias("_found"))

    def pseudonym(m: Column) -> Column:
        kind = F.coalesce(*(F.when(m.rlike(p), F.lit(k)) for k, p in _TELLS.items()))
        new = F.lit(None).cast("string")
        for k, make in _MAKERS.items():
            new = F.when(kind == k, make(key, m, back)).otherwise(new)
        return F.struct(kind.alias("kind"), m.alias("old"), new.alias("new"))

    run = lambda m: ~F.coalesce(*(F.when(m.rlike(p), F.lit(k)) for k, p in _TELLS.items())).isin(*(k for k in KINDS if k != "card"))
    rows = rows.withColumn("_found", F.transform("_found", lambda m: F.when(run(m), _in_run(m)).otherwise(F.array(m))))
    made = rows.withColumn("_made", F.when(F.size("_found") > 0, F.transform("_found", lambda parts: F.transform(parts, pseudonym))))
    parts = F.split("text", _ANY, -1)
    joined = F.array_join(F.zip_with(parts, F.col("_made"), lambda p, ms: F.concat(p, F.coalesce(F.array_join(F.transform(ms, lambda m: F.coalesce(m["new"], m["old"])), ""), F.lit("")))), "")
    count = lambda k: F.coalesce(F.size(F.filter(F.flatten("_made"), lambda m: m["new"].isNotNull() & ((m["kind"] == k) if k else F.lit(True)))), F.lit(0)).cast("bigint")
    return made.select("doc_id", F.when(F.col("_made").isNull(), F.col("text")).otherwise(joined).alias("text"), F.greatest(F.lit(0).cast("bigint"), count(None)).alias("n_found"), *(F.greatest(F.lit(0).cast("bigint"), count(k)).alias(f"n_{k}") for k in KINDS))
