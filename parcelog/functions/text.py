"""Text to values: column builders over messy listing text. Null in, null out unless stated."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def filled(match: Column) -> Column:
    """The match of a pattern, null where there was none."""
    return F.when(match != "", match)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def surrogate_key(*columns: Column) -> Column:
    """md5 of the columns' texts joined by ``|``, nulls as empty text."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))


def content_url(prefix: str, *columns: Column) -> Column:
    """A repeatable address for a row without one: prefix and a hash of its content."""
    return F.concat(F.lit(prefix), surrogate_key(*columns))


def price_digits(text: Column) -> Column:
    """All digits of a text as one number; null without digits or beyond 64 bits."""
    return filled(F.regexp_replace(text, "[^0-9]", "")).try_cast("bigint")


def decimal_number(text: Column) -> Column:
    """First number of a text, with point or comma."""
    return F.replace(filled(F.regexp_extract(text, r"([0-9]+(?:[.,][0-9]+)?)", 1)), F.lit(","), F.lit(".")).try_cast("double")


BLANK = r"[\s\u00a0\u202f]"


def floor_pair(text: Column) -> tuple[Column, Column]:
    """Floor and number of floors of a text with "5 из 9" anywhere; without that its first number as the floor."""
    floor, floors = (filled(F.regexp_extract(text, rf"([0-9]+){BLANK}*из{BLANK}*([0-9]+)", k)) for k in (1, 2))
    return F.coalesce(floor, filled(F.regexp_extract(text, "([0-9]+)", 1))).try_cast("int"), floors.try_cast("int")


def slash_pair(text: Column) -> tuple[Column, Column]:
    """Floor and number of floors of "5/9": the number at the start and the one behind a slash."""
    return tuple(filled(F.regexp_extract(text, pattern, 1)).try_cast("int") for pattern in ("^([0-9]+)", "/([0-9]+)"))


def rooms_of_title(title: Column) -> Column:
    """0 for a studio, else the number before "комн", with or without a hyphen between them."""
    low = F.lower(title)
    return F.when(low.contains("студи"), F.lit(0)).otherwise(filled(F.regexp_extract(low, rf"([0-9]+){BLANK}*-?{BLANK}*комн", 1)).try_cast("int"))


def first_year(text: Column) -> Column:
    """The first four digits in a row."""
    return filled(F.regexp_extract(text, r"([0-9]{4})", 1)).try_cast("int")


def id_of_url(url: Column, part: str = "flat") -> Column:
    """The number behind ``/part/`` in an address."""
    return filled(F.regexp_extract(url, rf"/{part}/([0-9]+)", 1)).try_cast("bigint")


def region_id_of_page(html: Column) -> Column:
    """The number behind the key regionId in a page."""
    return filled(F.regexp_extract(html, r'"regionId":\s*([0-9]+)', 1)).try_cast("bigint")


def district_name(name: Column) -> Column:
    """A district's name without the words for district: either one before it, the long one behind it."""
    return F.trim(F.regexp_replace(F.regexp_replace(name, rf"^(?:р-н|район){BLANK}+", ""), rf"{BLANK}+район$", ""))


#: Regions with keys of their own, and what is left out of the others' names, in this order (fixed values).
SPECIAL_REGIONS = {"Москва": "msk", "Московская область": "mo", "Санкт-Петербург": "spb", "Ленинградская область": "lo"}
REGION_WORDS = ("автономная область", "автономный округ", "республика", "область", "край", "респ.")


def region_key(name: Column, special: dict[str, str] = SPECIAL_REGIONS) -> Column:
    """Lower-case key of a region's name: words for its kind dropped, everything else than letters and digits ``_``."""
    own = name
    for given, key in special.items():
        own = F.when(name == given, F.lit(key)).otherwise(own)
    low = F.lower(own)
    for word in REGION_WORDS:
        low = F.replace(low, F.lit(word), F.lit(" "))
    return F.regexp_replace(F.regexp_replace(low, r"[^a-zа-яё0-9]+", "_"), r"^_+|_+$", "")


def room_keys(spec: Column) -> Column:
    """Sorted different room keys of "room1=1&room5=1": five and more are one; with a 9 it is a studio alone."""
    codes = F.transform(F.regexp_extract_all(spec, F.lit(r"room([0-9]+)="), F.lit(1)), lambda n: n.try_cast("bigint"))
    keys = F.array_sort(F.array_distinct(F.transform(codes, lambda n: F.when(n >= 5, "5+").otherwise(n.cast("string")))))
    return F.when(F.array_contains(codes, 9), F.array(F.lit("studio"))).otherwise(keys)


def price_label(low: Column, high: Column) -> Column:
    """ "2.5M-6M", "-800K", "3M-+": a price range in short; millions with six digits at most."""

    def short(x: Column) -> Column:
        places = F.when(x < 10**7, 5).when(x < 10**8, 4).when(x < 10**9, 3).when(x < 10**10, 2).when(x < 10**11, 1).otherwise(0)
        scale = F.pow(F.lit(10.0), places)
        millions = F.rint(x / 1_000_000 * scale) / scale
        digits = F.regexp_replace(F.regexp_replace(millions.cast("decimal(25,5)").cast("string"), "0+$", ""), r"\.$", "")
        return F.when(x >= 1_000_000, F.concat(digits, F.lit("M"))).otherwise(F.concat(F.floor(x / 1000).cast("string"), F.lit("K")))

    return F.concat(F.coalesce(short(low), F.lit("")), F.lit("-"), F.coalesce(short(high), F.lit("+")))


def view_counts(text: Column) -> tuple[Column, Column]:
    """All and today's views of "1 234 просмотра, 56 за сегодня": the number at the start, and the one between a comma and
    the words for today; blanks and no-break spaces may stand in both."""
    blank, number = r"\s\u00a0\u202f", r"([0-9\s\u00a0\u202f]+)"
    digits = lambda pattern: filled(F.regexp_replace(F.regexp_extract(text, pattern, 1), "[^0-9]", "")).try_cast("int")
    return digits(rf"^{number}"), digits(rf",{number}[{blank}]за сегодня")


def completion_text(quarter: Column, year: Column, finish_quarter: Column, finish_year: Column, info: Column) -> Column:
    """ "3 кв. 2027" from the deadline's quarter and year, else from the finish date's, else the given text. A year without
    quarter stands alone; quarters are named or numbered, unknown ones stay as given; a year of zero is none."""

    def text(q: Column, y: Column) -> Column:
        own = y.cast("string")
        return F.when(y != 0, F.coalesce(F.concat(filled(q), F.lit(" кв. "), own), own))

    named = F.when(quarter == "first", "1").when(quarter == "second", "2").when(quarter == "third", "3").when(quarter == "fourth", "4").otherwise(quarter)
    return F.coalesce(text(named, year), text(F.nullif(finish_quarter, F.lit("0")), finish_year), filled(info))


def counts_text(counts: list[tuple[Column, str]]) -> Column:
    """ "1 разд., 2 совм." of the counts above zero; null if none is."""
    return filled(F.concat_ws(", ", *[F.when(n > 0, F.concat(n.cast("string"), F.lit(f" {label}"))) for n, label in counts]))


def count_before(text: Column, token: str) -> Column:
    """The number before a token; -1 for null text, 0 without the token."""
    return F.when(text.isNull(), -1).otherwise(F.coalesce(filled(F.regexp_extract(text, rf"([0-9]+)\s*{token}", 1)).try_cast("int"), F.lit(0)))


def contains_flag(text: Column, word: str) -> Column:
    """True with the word, false for other text, null for none or blank text."""
    return F.when(F.lower(text).contains(word), True).when(F.trim(text) != "", False)


def without_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def links(html: Column, pattern: str) -> Column:
    """All different links of a page that match, query parts cut off, in order of first sight."""
    return F.array_distinct(F.transform(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), lambda u: F.substring_index(u, "?", 1)))


#: Marks of pages that aren't the ones asked for, and statuses that say so (fixed values).
WAF_STATUS, WAF_SIGNS = (403, 429, 503), ("waf_block", "waf_rate_limit")
CAPTCHA_SIGNS = ("smartcaptcha", "captcha-api.yandex", "не робот")
VPN_SIGNS = ("похоже, у вас включен vpn", "кажется, у вас включён vpn")
HEAD = 32_768


def page_class(status: Column, html: Column, url: Column | None = None) -> Column:
    """waf by status or mark, captcha by address or mark, vpn by mark, else ok; marks are sought in the first ``HEAD`` characters."""
    head = F.lower(F.substring(html, 1, HEAD))
    address = F.coalesce(F.lower(url).contains("captcha"), F.lit(False)) if url is not None else F.lit(False)
    return F.when(status.isin(*WAF_STATUS) | _any_of(head, WAF_SIGNS), "waf").when(address | _any_of(head, CAPTCHA_SIGNS), "captcha").when(_any_of(head, VPN_SIGNS), "vpn").otherwise("ok")


def _any_of(text: Column, signs: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for sign in signs:
        found = found | text.contains(sign)
    return F.coalesce(found, F.lit(False))


#: What tells the parts of an address line apart, in the order in which it is tried (fixed values).
DISTRICT_PART = r"(?iu)р-н|район"
REGION_PART = r"^[А-ЯЁA-Z]{2,5}$"
STREET_PART = r"(?iu)ул\.|улица|пер\.|переулок|просп|пр-т|ш\.|шоссе|б-р|бульвар|наб\.|набережная|пр-д|проезд"


def address(text: Column) -> Column:
    """City, region, district, street and house_number of a comma-separated address, as one struct.

    The city is the first part. The others are folded in order: a part with a district's mark, a short one of capitals, one
    with a street's mark count as district, region and street (later ones win), and the first that begins with a digit behind
    a street is the house. Where no street is marked, and two parts or more follow the city, the first two of them that are
    neither region nor district are street and house. Empty text has no parts.
    """
    names = ("district", "region", "street", "house_number")

    def state(*values: Column) -> Column:
        return F.struct(*[v.alias(n) for n, v in zip(names, values, strict=True)])

    def blank(x: Column) -> Column:
        return F.coalesce(x, F.lit("")) == ""

    def kind(p: Column) -> Column:
        return F.when(p.rlike(DISTRICT_PART), 0).when(p.rlike(REGION_PART), 1).when(p.rlike(STREET_PART), 2).when(p.rlike("^[0-9]"), 3).otherwise(4)

    def marked(own: Column) -> Column:
        of = lambda k, at: F.try_element_at(F.filter(own, lambda x: x["kind"] == k), F.lit(at))["part"]
        street = F.array_position(F.transform(own, lambda x: x["kind"]), 2)
        house = F.try_element_at(F.filter(own, lambda x, i: (x["kind"] == 3) & (street > 0) & (i >= street)), F.lit(1))["part"]
        return state(of(0, -1), of(1, -1), of(2, -1), house)

    def unmarked(s: Column, p: Column) -> Column:
        free = ~(p.eqNullSafe(s["region"]) | p.eqNullSafe(s["district"]))
        street = blank(s["street"])
        own = (free & street, free & ~street & blank(s["house_number"]))
        return state(s["district"], s["region"], *[F.when(take, p).otherwise(s[n]) for n, take in zip(names[2:], own, strict=True)])

    def fields(own: Column) -> Column:
        """City and the rest; ``own`` are the parts, the city first, each with its kind."""
        rest = F.slice(own, F.lit(2), F.size(own))
        fallback = lambda s, rest: F.aggregate(F.transform(rest, lambda x: x["part"]), s, unmarked)
        whole = let(rest, lambda rest: let(marked(rest), lambda s: F.when(blank(s["street"]) & (F.size(rest) >= 2), fallback(s, rest)).otherwise(s)))
        return let(whole, lambda w: F.struct(own[0]["part"].alias("city"), *[w[n].alias(n) for n in ("region", "district", "street", "house_number")]))

    trimmed = F.transform(F.split(text, ","), lambda p: F.regexp_replace(p, rf"^{BLANK}+|{BLANK}+$", ""))
    parts = F.transform(trimmed, lambda p, i: F.struct(p.alias("part"), F.when(i > 0, kind(p)).alias("kind")))
    return F.when(text != "", let(parts, fields))


def address_parts(text: Column) -> dict[str, Column]:
    """The fields of ``address`` by name."""
    own = address(text)
    return {n: own[n] for n in ("city", "region", "district", "street", "house_number")}
