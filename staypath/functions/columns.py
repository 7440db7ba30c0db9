"""Column expressions over log fields; all native, so they stay inside generated code.

Arguments are SQL text: a column name or any expression. Results are columns.
"""

from pyspark.sql import Column, functions as F

from staypath.schema import DAY_PARTS

# Bracketed spans and the filler word dropped from user agents.
BRACKETED = r"(?d)[(\[].*?[)\]]"
FILLER = "like"
# Unicode blanks plus the four ASCII separators that \s leaves out.
BLANKS = r"(?U)[\s\x1c-\x1f]+"


def ratio(part: str, whole: str, name: str) -> Column:
    """``part / whole`` as double, null where ``whole`` is zero or null."""
    return F.expr(f"try_divide(double({part}), double({whole})) as {name}")


# first and last millisecond of the years 1 to 9999; other epoch values are junk and count as missing
FIRST_MILLIS, LAST_MILLIS = -62_135_596_800_000, 253_402_300_799_999


def valid_sql(millis: str) -> str:
    """An epoch-ms value, null outside the years 1 to 9999."""
    return f"(case when {millis} between {FIRST_MILLIS} and {LAST_MILLIS} then {millis} end)"


def day_sql(millis: str) -> str:
    return f"to_date(timestamp_millis({valid_sql(millis)}))"


def event_day(millis: str) -> Column:
    """Calendar day of an epoch-ms column in the session time zone."""
    return F.expr(day_sql(millis))


def day_text(millis: str) -> Column:
    """The same day as ``yyyy-MM-dd`` text."""
    return F.expr(f"date_format(timestamp_millis({valid_sql(millis)}), 'yyyy-MM-dd')")


def day_part(millis: str) -> Column:
    """One of four day parts; an hour belongs to the part it closes (6:59 is still ``1am ~ 6am``)."""
    hour = f"hour(timestamp_millis({valid_sql(millis)}))"
    return F.expr(f"""
        case when {hour} is null then null
             when {hour} between 1 and 6 then '{DAY_PARTS[0]}'
             when {hour} between 7 and 12 then '{DAY_PARTS[1]}'
             when {hour} between 13 and 18 then '{DAY_PARTS[2]}'
             else '{DAY_PARTS[3]}' end""")


def days_until(as_of: Column, day: Column | str) -> Column:
    """Whole days from ``day`` to an explicit ``as_of`` date."""
    return F.datediff(as_of, day)


def agent_tokens(agent: str) -> Column:
    """Product names in a user agent, without versions and bracketed remarks."""
    plain = f"""replace(regexp_replace({agent}, r'{BRACKETED}', ''), '"', '')"""
    words = f"filter(split({plain}, r'{BLANKS}'), w -> w <> '' and w <> '{FILLER}')"
    return F.expr(f"transform({words}, w -> substring_index(w, '/', 1))")


def state_codes(location: str) -> Column:
    """Sorted distinct state codes between the first and second comma; null without a comma."""
    codes = f"split(get(split({location}, ','), 1), '-')"
    return F.expr(f"sort_array(array_distinct(transform({codes}, c -> replace(c, ' ', ''))))")


def song_title(artist: str = "artist", song: str = "song") -> Column:
    """``artist - song``, null if either part is null."""
    return F.expr(f"concat({artist}, ' - ', {song})")


def length_sql(length: str, decimals: int | None) -> str:
    """A play length as it is summed.

    Doubles by default. With ``decimals`` lengths count as whole numbers of 10^-decimals seconds,
    so a sum does not depend on row order; shares of such sums need no scaling back.
    """
    return length if decimals is None else f"floor({length} * {10**decimals} + 0.5D)"


# bits of a short recency key: milliseconds to 2039, item numbers to a million, two flags
TIME_BITS, ITEM_BITS, FLAG_BITS = 41, 20, 2
LOW_BITS = ITEM_BITS + FLAG_BITS


def recency_sql(time: str, item: str, flags: str) -> str:
    """Sort key of an event, newest largest, with a flag number 0..3 in its low end.

    Covers every item number and the years 1 to 9999. Missing and junk times sort below all others,
    missing item numbers below item 0.
    """
    when = f"cast(coalesce({valid_sql(time)}, {-10**17}) as decimal(18, 0))"
    low = f"(coalesce(cast({item} as decimal(19, 0)) + 1, 0)) * 4 + cast({flags} as decimal(1, 0))"
    return f"{when} * {10**20} + {low}"


def latest_sql(time: str, item: str, flags: str) -> str:
    """Aggregate: the largest :func:`recency_sql` of a group.

    Numbers keep ``max`` in a hash aggregate; a struct would force a sort of the log. Nearly all
    keys fit a bigint, which is several times cheaper per row than the decimal, so the decimal is
    computed per group, and per row only where the short key has no room.
    """
    number = f"(least(coalesce({item}, -1), {2**ITEM_BITS}) + 1)"
    fits = f"coalesce({time} between 0 and {2**TIME_BITS - 1}, false) and {number} between 0 and {2**ITEM_BITS - 1}"
    short = f"max(case when {fits} then shiftleft({time}, {LOW_BITS}) + shiftleft({number}, {FLAG_BITS}) + {flags} end)"
    from_short = (
        f"cast(shiftright({short}, {LOW_BITS}) as decimal(18, 0)) * {10**20} "
        f"+ cast({short} & {2**LOW_BITS - 1} as decimal(19, 0))"
    )
    return f"greatest({from_short}, max(case when not ({fits}) then {recency_sql(time, item, flags)} end))"


def recency_flags_sql(key: str) -> str:
    """The flag number stored in a recency key."""
    return f"int(pmod({key}, cast(4 as decimal(38, 0))))"
