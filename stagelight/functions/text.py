"""Column functions on names, titles, dates and identifiers. All stay in the JVM; none looks at the clock: where a rule
needs today, the caller passes it as `as_of`."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NIL_UUID = "00000000-0000-0000-0000-000000000000"
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"

# Words and phrases the rules look for.
NON_ARTIST_WORDS = ("open mic", "karaoke", "trivia", "comedy", "open jam", "dj night", "bingo")
VENUE_NOISE = ("the ", " tavern", " bar", " club", " lounge")
ARTIST_NOISE = ("the ", " band", " trio", " quartet")
TOKEN_NOISE = ("presents", "show", "concert")
NOT_BANDS = ("OPEN 4PM", "FOR BOOKING", "SEVEN DAYS", "SUGGESTED DONATION", "HOSTED BY", "(unless otherwise noted)", "THURSDAY SHOWS", "FRI/SAT SHOWS")
SLUG_PUNCTUATION = "'\".,!?&"


def _without(c: Column, parts: tuple[str, ...]) -> Column:
    return reduce(lambda x, p: F.replace(x, F.lit(p), F.lit("")), parts, c)


def slug_keep_runs(name: Column) -> Column:
    """Lower case, spaces to hyphens, some punctuation deleted, other characters than letters, digits and hyphens
    deleted; runs of hyphens stay."""
    hyphened = F.translate(F.replace(F.lower(name), F.lit(" "), F.lit("-")), SLUG_PUNCTUATION, "")
    return F.regexp_replace(F.regexp_replace(hyphened, r"[^\p{IsAlphabetic}\p{N}-]", ""), r"^-+|-+$", "")


def slug(name: Column) -> Column:
    """Every run of other characters than letters and digits becomes one hyphen; none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(name), r"[^\p{IsAlphabetic}\p{N}]+", "-"), r"^-+|-+$", "")


def slug_ascii(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(name), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def slug_simple(name: Column) -> Column:
    return F.replace(F.lower(name), F.lit(" "), F.lit("-"))


def match_name(name: Column) -> Column:
    """Form in which entity names are compared; double spaces are halved once, not collapsed."""
    x = F.replace(F.trim(F.lower(name)), F.lit("&"), F.lit("and"))
    return F.replace(F.translate(x, "-_", "  "), F.lit("  "), F.lit(" "))


def venue_core_name(name: Column) -> Column:
    return F.trim(_without(F.lower(name), VENUE_NOISE))


def artist_core_name(name: Column) -> Column:
    return F.trim(_without(F.lower(name), ARTIST_NOISE))


def tokens(text: Column) -> Column:
    return F.filter(F.array_distinct(F.split(text, r"\s+")), lambda t: t != "")


def token_jaccard(a: Column, b: Column) -> Column:
    x, y = tokens(a), tokens(b)
    union = F.size(F.array_union(x, y))
    return F.when((a == b) | (union == 0), 1.0).otherwise(F.size(F.array_intersect(x, y)) / union)


def levenshtein_similarity(a: Column, b: Column) -> Column:
    n, m = F.char_length(a), F.char_length(b)
    return F.when(a == b, 1.0).when((n == 0) | (m == 0), 0.0).otherwise(1 - F.levenshtein(a, b) / F.greatest(n, m))


def title_or_null(title: Column) -> Column:
    return F.nullif(F.trim(title), F.lit(""))


def is_non_artist(title: Column) -> Column:
    return F.lower(title).rlike("|".join(NON_ARTIST_WORDS))


def artist_tokens(parts: Column) -> Column:
    """Drops tokens that name the promotion rather than a performer, and those under two bytes."""
    return F.filter(parts, lambda t: ~F.lower(t).rlike("|".join(TOKEN_NOISE)) & (F.octet_length(t) >= 2))


def is_band_paragraph(text: Column) -> Column:
    """Not blank, none of the house's notices, and with a link or a capital letter."""
    t = F.trim(text)
    notice = reduce(lambda x, p: x | t.contains(p), NOT_BANDS, F.lit(False))
    return (t != "") & ~notice & (t.contains("http") | t.rlike(r"\p{Lu}"))


def split_artists(title: Column) -> Column:
    """At , & + / | : trimmed, blanks dropped."""
    return F.filter(F.transform(F.split(title, r"[,&+/|]"), lambda x: F.trim(x)), lambda t: t != "")


def performers(title: Column) -> Column:
    """Whole title for known kinds of evenings, else its parts of more than one byte."""
    t = F.lower(title)
    whole = t.rlike("open mic|karaoke|bingo") | (t.contains("art") & t.contains("craft")) | (t.contains("dj") & ~t.contains("dj "))
    return F.when(whole, F.array(title)).otherwise(F.filter(split_artists(title), lambda x: F.octet_length(x) > 1))


def title_artists(title: Column) -> Column:
    """Artists that a title names: of "Name LIVE on KEXP (...)" the one before it, if its name is over two bytes; else the
    parts of the title. Tokens that name the promotion are dropped."""
    before = F.trim(F.split_part(title, F.lit(" LIVE on KEXP"), F.lit(1)))
    none = F.array().cast("array<string>")
    named = F.when(title.contains("LIVE on KEXP"), F.when(F.octet_length(before) > 2, F.array(before)).otherwise(none)).otherwise(split_artists(title))
    return artist_tokens(named)


def headliner(title: Column) -> Column:
    """What stands before "feat" in any case, without closing exclamation marks."""
    at = F.locate("feat", F.lower(title))
    return F.regexp_replace(F.trim(F.when(at > 0, F.substr(title, F.lit(1), at - 1)).otherwise(title)), "!+$", "")


def featured(title: Column) -> Column:
    """What stands after the first word that goes on from "feat" in any case, from its first letter on, split at , & and +."""
    rest = F.regexp_extract(title, r"(?is)feat\p{IsAlphabetic}*[^\p{IsAlphabetic}]*(.*)$", 1)
    return F.filter(F.transform(F.split(rest, "[,&+]"), lambda x: F.trim(x)), lambda t: t != "")


def with_acts(title: Column) -> Column:
    """Parts at " with ", the later ones split at , & +."""
    first = F.split(title, "(?i) with ", 2)
    rest = F.coalesce(F.get(first, 1), F.lit(""))
    return F.concat(F.array(F.trim(F.get(first, 0))), F.filter(F.transform(F.split(rest, "[,&+]"), lambda x: F.trim(x)), lambda t: t != ""))


def legacy_title_artists(title: Column) -> Column:
    """The archived rule: nothing for four kinds of evenings; parts at " with ", else at " & ", else the whole title
    unless it speaks of a night, show or party."""
    t = F.lower(title)
    return (
        F.when(t.rlike("open mic|karaoke|trivia|comedy"), F.array().cast("array<string>"))
        .when(t.contains(" with "), F.transform(F.split(title, "(?i) with "), lambda x: F.trim(x)))
        .when(title.contains(" & "), F.transform(F.split(title, " & "), lambda x: F.trim(x)))
        .when(t.rlike("night|show|party"), F.array().cast("array<string>"))
        .otherwise(F.array(F.trim(title)))
    )


def categories(title: Column) -> Column:
    t = F.lower(title)
    rules = (("karaoke", "Karaoke"), ("open mic|open-mic", "Open Mic"), ("art|craft", "Arts & Crafts"), ("bingo", "Games"), ("dj", "DJ"), ("festival", "Festival"))
    return F.array_compact(F.array(F.lit("Music"), *[F.when(t.rlike(p), F.lit(name)) for p, name in rules]))


def skip_reason(title: Column) -> Column:
    """Why a radio-station listing is no public event; null if it is one."""
    t = F.lower(title)
    return F.when(t.contains("live on kexp") & ~t.contains("open to the public"), "broadcast only").when(t.contains("book reading"), "book reading")


def uuid5(name: Column, namespace: str = DNS_NAMESPACE) -> Column:
    """Name-based id, by SHA-1 over the namespace's bytes and the name."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.lower(F.lpad(F.hex(F.conv(F.substring(h, 17, 2), 16, 10).cast("int").bitwiseAND(F.lit(0x3F)).bitwiseOR(F.lit(0x80))), 2, "0"))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 19, 2)), F.substring(h, 21, 12))


def idempotency_key(source: Column, url: Column, etag: Column, modified: Column, payload_sha: Column) -> Column:
    return F.sha2(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in (source, url, etag, modified, payload_sha)]), 256)


def dedup_signature(*fields: Column, lat: Column | None = None, lng: Column | None = None) -> Column:
    parts = [F.coalesce(F.lower(f), F.lit("")) for f in fields] + [F.coalesce(F.round(c * 1e4).cast("long").cast("string"), F.lit("")) for c in (lat, lng) if c is not None]
    return F.sha2(F.concat_ws("|", *parts), 256)


def last_segment(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def absolute_url(url: Column, origin: str) -> Column:
    return F.when(url.startswith("http"), url).otherwise(F.concat(F.lit(origin), url))


def unescape_html(text: Column) -> Column:
    """Named and numbered signs once: &amp; is read last, so that what it makes is not read again."""
    pairs = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#039;", "'"), ("&nbsp;", " "), ("&#8217;", "’"), ("&#8211;", "–"), ("&amp;", "&"))
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, text)


def unescape_json(text: Column) -> Column:
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), (('\\"', '"'), ("\\/", "/"), ("\\n", "\n")), text)


def base_mime(content_type: Column) -> Column:
    return F.trim(F.split_part(content_type, F.lit(";"), F.lit(1)))


# Dates and times. Text that is no date gives null, never an error.

MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()


def month_number(name: Column) -> Column:
    """1 to 12 from a month's name or abbreviation; null if it is none."""
    at = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.substring(F.trim(name), 1, 3)))
    return F.when(at > 0, at.cast("int"))


def try_date(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.format_string("%04d-%02d-%02d", year.cast("int"), month.cast("int"), day.cast("int")), "yyyy-MM-dd")


def parse_day(text: Column) -> Column:
    """RFC 3339, ISO, "January 15, 2025" and "1/15/2025", with or without a weekday before it."""
    x = F.regexp_replace(F.trim(text), r"(?i)^(mon|tues|wednes|thurs|fri|satur|sun)day,?\s+", "")
    iso = F.try_to_date(F.nullif(F.regexp_extract(x, r"^(\d{4}-\d{2}-\d{2})", 1), F.lit("")), "yyyy-MM-dd")  # a failure is an exception for each row
    return F.coalesce(iso, F.try_to_date(x, "MMMM d, yyyy"), F.try_to_date(x, "M/d/yyyy"))


def day_of_year_roll(month: Column, day: Column, as_of: Column) -> Column:
    """Date in the year of as_of, or the next year for an earlier month from October on."""
    next_year = (month < F.month(as_of)) & (F.month(as_of) >= 10)
    return try_date(F.year(as_of) + F.when(next_year, 1).otherwise(0), month, day)


def ordinal_day(text: Column, as_of: Column) -> Column:
    """"Aug 31st": this year, or next year if it has passed."""
    plain = F.regexp_replace(F.trim(text), r"(?i)(?<=\d)(st|nd|rd|th)", "")
    month, day = month_number(F.regexp_extract(plain, r"^([A-Za-z]+)", 1)), F.regexp_extract(plain, r"(\d{1,2})", 1).try_cast("int")
    this = try_date(F.year(as_of), month, day)
    return F.when(this < as_of, try_date(F.year(as_of) + 1, month, day)).otherwise(this)


def weekday_day(text: Column, as_of: Column) -> Column:
    """"friday 08.29" in the year of as_of."""
    pattern = r"(?i)(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\s+(\d{2})\.(\d{2})"
    return try_date(F.year(as_of), F.regexp_extract(text, pattern, 1).try_cast("int"), F.regexp_extract(text, pattern, 2).try_cast("int"))


def parse_time(text: Column) -> Column:
    """HH:mm:ss from "7:30 PM", "19:30", "noon", "midnight" or "1 p.m."."""
    t = F.lower(F.trim(text))
    short = r"^(\d{1,2})(?::(\d{2}))?\s*([ap])\.?m\.?"
    hour = F.regexp_extract(t, short, 1).try_cast("int") % 12 + F.when(F.regexp_extract(t, short, 3) == "p", 12).otherwise(0)
    minute = F.coalesce(F.regexp_extract(t, short, 2).try_cast("int"), F.lit(0))
    plain = F.regexp_extract(t, r"^(\d{1,2}):(\d{2})", 1).try_cast("int")
    return (
        F.when(t == "noon", "12:00:00").when(t == "midnight", "00:00:00")
        .when(t.rlike(short) & (minute < 60), F.format_string("%02d:%02d:00", hour, minute))
        .when(t.rlike(r"^\d{1,2}:\d{2}") & (plain < 24), F.format_string("%02d:%s:00", plain, F.regexp_extract(t, r"^\d{1,2}:([0-5]\d)", 1)))
    )


def iso_start_time(text: Column) -> Column:
    """Clock part of "2025-01-15T19:30:00-08:00"."""
    return F.nullif(F.split_part(F.split_part(text, F.lit("T"), F.lit(2)), F.lit("-"), F.lit(1)), F.lit(""))


def infer_day(record: Column, as_of: Column) -> Column:
    """Day of a JSON record from the first of its start or date fields that holds a whole number (epoch seconds) or text of
    ten characters or more (a date in its first ten); as_of if there is none, or if that text is no date."""
    fields = [F.get_json_object(record, p) for p in ("$.start.date", "$.startDate", "$.date", "$.event_day")]
    number = lambda f: f.rlike(r"^-?\d{1,18}$")
    day = lambda f: F.when(number(f), F.to_date(F.timestamp_seconds(f.try_cast("long")))).otherwise(F.try_to_date(F.substring(f, 1, 10), "yyyy-MM-dd"))
    found = F.array_compact(F.array(*[F.when(number(f) | (F.char_length(f) >= 10), F.struct(day(f).alias("day"))) for f in fields]))
    return F.coalesce(F.get(found, 0)["day"], as_of)
