"""Who filed: filings matched to members by name, seat and service."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions import scalars as S
from ledgerspark.schema import IDENTITY

KEY = ["chamber", "doc_id"]


def _sorted(df: DataFrame) -> DataFrame:
    """A table of all members or filings, joined by sorting: files say little of its rows' size in memory, so Spark would send millions of them through the driver."""
    return df.hint("merge")


def legislator_terms(people: DataFrame) -> DataFrame:
    """``bioguide, type, start, end, state, district`` of nested ``terms``; a senator's district is null."""
    t = people.select("bioguide", F.explode("terms").alias("t")).where(F.col("t.type").isin("rep", "sen"))
    return t.select(
        "bioguide", "t.type", F.col("t.start").cast("date").alias("start"), F.col("t.end").cast("date").alias("end"), "t.state", F.when(F.col("t.type") == "rep", F.col("t.district")).cast("int").alias("district")
    )


def _spoken(words: Column) -> Column:
    """Words as one text, each behind a blank."""
    return F.concat(F.lit(" "), F.array_join(words, " "))


def _beginnings(words: Column) -> Column:
    """First three letters of each word; given names that share one may be one person's."""
    return F.transform(words, lambda w: F.left(w, F.lit(3)))


def prepared(filings: DataFrame) -> DataFrame:
    """Filings with name tokens, name key, display name and seat. Tokens are made once for each distinct name, as folding accents takes Python."""
    names = filings.select("filer_first", "filer_last").distinct()
    tokens = names.select(F.struct("filer_first", "filer_last").alias("_as"), S.name_tokens(F.col("filer_last")).alias("_last"), S.name_tokens(F.col("filer_first")).alias("_first"))
    f = filings.select(*KEY, "filer_first", "filer_last", "state_district", "filing_date").join(tokens, F.struct("filer_first", "filer_last").eqNullSafe(F.col("_as"))).drop("_as")
    return f.select("*", S.name_key(F.col("chamber"), F.col("_last"), F.col("_first")).alias("_name"), S.display_name(F.col("filer_first"), F.col("filer_last")).alias("_shown"), S.seat_of(F.col("chamber"), F.col("state_district")).alias("_seat"))


#: Behind the last day of a term without an end.
_OPEN = "9999-12-31"


def _key(name: Column, kind: Column, district: Column, given: Column, state: Column) -> Column:
    return F.concat_ws("|", name, kind, district, given, F.coalesce(F.concat(F.lit("in "), state), F.lit("*")))


def _endings(words: Column) -> Column:
    """Every ending of a name, word by word, itself first."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1))), lambda i: _spoken(F.slice(words, i, F.size(words))))


def _asked(filings: DataFrame) -> DataFrame:
    """``_rank, _key`` under which a filing's candidates are found; ``_shape`` is what the key leaves open.

    ``f``: members whose name ends with the filed one; ``s``: members named as a proper
    ending of it; ``x``: of exactly that name, whatever their district. The ranks are the
    order in which candidates count: with the district and the given name, with the
    district, exact with the given name, exact.
    """
    words, no = F.col("_last"), F.lit("*")
    district = F.col("_seat.district").cast("string")
    names = F.transform(_endings(words), lambda w, i: F.concat(F.when(i == 0, "f").otherwise("s"), w))
    where = F.when(district.isNull(), F.array(no)).otherwise(F.array(district, F.lit("-")))
    strict = F.flatten(F.transform(names, lambda n: F.transform(where, lambda d: F.struct(F.lit(2).alias("rank"), n.alias("name"), d.alias("district")))))
    loose = F.when(district.isNotNull(), F.array(F.struct(F.lit(4).alias("rank"), F.concat(F.lit("x"), _spoken(words)).alias("name"), no.alias("district"))))
    given = F.concat(F.array(no), F.array_distinct(_beginnings(F.col("_first"))))
    f = filings.where(F.size("_last") > 0).select(*KEY, "filing_date", "_seat", given.alias("_given"), F.explode(F.concat(strict, F.coalesce(loose, F.slice(strict, 1, 0)))).alias("_q"))
    shape = F.concat_ws("|", F.left("_q.name", F.lit(1)), "_seat.type", F.when(F.col("_q.district").rlike("[0-9]"), "d").otherwise(F.col("_q.district")), F.when(F.col("_seat.state").isNull(), no).otherwise("in"))
    f = f.select(*KEY, "filing_date", "_seat", "_q", shape.alias("_shape"), F.explode("_given").alias("_g"))
    return f.select(
        *KEY, "_shape", F.col("filing_date").alias("_at"), (F.col("_q.rank") - F.when(F.col("_g") == "*", 0).otherwise(1)).alias("_rank"),
        _key(F.col("_q.name"), F.col("_seat.type"), F.col("_q.district"), F.col("_g"), F.col("_seat.state")).alias("_key"),
    )


def _seats(members: DataFrame, terms: DataFrame, shapes: DataFrame) -> DataFrame:
    """``_key, _a, _b, start, end`` of members' terms, under every key of the ``shapes`` that filings ask for; ``_a, _b`` are 128 bits of the member's id."""
    no = F.lit("*")
    m = members.select("bioguide", S.name_tokens(F.col("last")).alias("_words"), _beginnings(S.name_tokens(F.concat_ws(" ", "first", "middle", "nickname"))).alias("_given")).where(F.size("_words") > 0)
    whole, kind = _spoken(F.col("_words")), lambda k, w: F.struct(F.lit(k).alias("kind"), w.alias("name"))
    names = F.concat(F.array(kind("s", whole), kind("x", whole)), F.transform(_endings(F.col("_words")), lambda w: kind("f", w)))
    m = _sorted(m).join(terms.where("start is not null"), "bioguide").withColumn("_given", F.concat(F.array(no), F.array_distinct("_given")))
    m = m.select("*", F.explode(names).alias("_n")).drop("_words")
    own = F.coalesce(F.col("district").cast("string"), F.lit("-"))
    m = m.select("*", F.explode(F.array_distinct(F.array(no, own))).alias("_d")).select("*", F.explode(F.array_distinct(F.array(F.col("state"), F.lit(None).cast("string")))).alias("_s"))
    shape = F.concat_ws("|", "_n.kind", "type", F.when(F.col("_d").rlike("[0-9]"), "d").otherwise(F.col("_d")), F.when(F.col("_s").isNull(), no).otherwise("in"))
    m = m.withColumn("_shape", shape).join(F.broadcast(shapes), "_shape", "left_semi")  # 36 shapes at most
    return m.select("*", F.explode("_given").alias("_g")).select(
        _key(F.concat("_n.kind", "_n.name"), F.col("type"), F.col("_d"), F.col("_g"), F.col("_s")).alias("_key"), *_ids("bioguide"), "start", F.coalesce("end", F.lit(_OPEN).cast("date")).alias("end")
    )


def _ids(bioguide: str) -> list[Column]:
    return [F.xxhash64(bioguide).alias("_a"), F.xxhash64(F.lit("member"), bioguide).alias("_b")]


def _changes(seats: DataFrame) -> DataFrame:
    """What changes under a key on a day ``_at``: members in office (``_n``, and ``_x, _y`` by exclusive or), and ``_ended``: the end of those out of it, how many ended then, and who."""
    seats = seats.repartition("_key")  # all below goes by key
    mine = Window.partitionBy("_key", "_a", "_b").orderBy("start", "end")
    before = F.max("end").over(mine.rowsBetween(Window.unboundedPreceding, -1))
    sat = seats.where("end >= start").withColumn("_new", F.when(F.col("start") <= before, 0).otherwise(1)).withColumn("_island", F.sum("_new").over(mine.rowsBetween(Window.unboundedPreceding, 0)))
    sat = sat.groupBy("_key", "_a", "_b", "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"))  # a member's overlapping terms are one
    none = F.lit(None).cast("struct<day:date,n:bigint,a:bigint,b:bigint>")
    day = lambda at, n: F.struct(at.alias("_at"), F.lit(n).cast("long").alias("_n"))
    moves = sat.select("_key", "_a", "_b", F.explode(F.array(day(F.col("start"), 1), day(F.date_add("end", 1), -1))).alias("_d"))
    moves = moves.groupBy("_key", F.col("_d._at").alias("_at")).agg(F.sum("_d._n").alias("_n"), F.expr("bit_xor(_a)").alias("_x"), F.expr("bit_xor(_b)").alias("_y")).withColumn("_ended", none)
    # A term that ends before it starts counts from its start on, as one that has ended.
    left = sat.select("_key", "_a", "_b", "end", F.date_add("end", 1).alias("_at")).union(seats.where("end < start").select("_key", "_a", "_b", "end", F.col("start")))
    left = left.groupBy("_key", "_a", "_b", "end").agg(F.min("_at").alias("_at")).groupBy("_key", "end", "_at").agg(F.count(F.lit(1)).alias("_n"), F.expr("bit_xor(_a)").alias("_x"), F.expr("bit_xor(_b)").alias("_y"))
    upto = Window.partitionBy("_key", "end").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    ended = F.struct(F.col("end").alias("day"), F.sum("_n").over(upto).alias("n"), F.expr("bit_xor(_x)").over(upto).alias("a"), F.expr("bit_xor(_y)").over(upto).alias("b"))
    zero = F.lit(0).cast("long")
    return moves.unionByName(left.select("_key", "_at", zero.alias("_n"), zero.alias("_x"), zero.alias("_y"), ended.alias("_ended")))


def matches(filings: DataFrame, members: DataFrame, terms: DataFrame) -> DataFrame:
    """``chamber, doc_id, bioguide`` where the rules leave one member. ``filings`` as from prepared().

    Candidates' last names end with the filed one or the filed one with theirs, and they
    served in the seat's chamber (and state and district, where the filing has them) by the
    filing date. If none has the district, members of exactly that last name count whatever
    their district. Then those with a fitting given name, if any, then those who served
    last. More than one left is no match. A filing meets no candidate: under each of the
    keys that it asks for, terms are changes of who is in office, sorted with the filings
    by day, and their running count and exclusive or say whether one member is left and
    who; so the work grows with filings and terms and not with their product.
    """
    asked = _asked(filings)
    shapes = asked.select("_shape").distinct()
    null = F.lit(None)
    changes = _changes(_seats(members, terms, shapes)).select(
        "_key", "_at", *[null.cast("string").alias(c) for c in KEY], null.cast("int").alias("_rank"), "_n", "_x", "_y", "_ended"
    )
    zero = F.lit(0).cast("long")
    both = changes.union(asked.select("_key", "_at", *KEY, "_rank", zero, zero, zero, null.cast("struct<day:date,n:bigint,a:bigint,b:bigint>")))
    by_day = Window.partitionBy("_key").orderBy(F.col("_at").asc_nulls_first(), F.col("_rank").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    state = both.select(
        "*", F.sum("_n").over(by_day).alias("n"), F.expr("bit_xor(_x)").over(by_day).alias("a"), F.expr("bit_xor(_y)").over(by_day).alias("b"), F.max("_ended").over(by_day).alias("ended")
    ).where("_rank is not null and _at is not null and (n > 0 or ended is not null)")
    now = F.when(F.col("n") > 0, F.struct(F.col("_at").alias("day"), "n", "a", "b")).otherwise(F.col("ended"))
    found = state.select(*KEY, "_rank", F.unix_date(now["day"]).alias("day"), now["n"].alias("n"), now["a"].alias("a"), now["b"].alias("b"))
    best = found.groupBy(*KEY).agg(F.max(F.struct(-F.col("_rank"), "day", "n", "a", "b")).alias("hi"), F.min(F.struct("_rank", -F.col("day"), -F.col("n"), "a", "b")).alias("lo"))
    one = best.where("hi.n = 1 and hi.a = lo.a and hi.b = lo.b").select(*KEY, F.col("hi.a").alias("_a"), F.col("hi.b").alias("_b"))
    return one.join(_sorted(members.select("bioguide", *_ids("bioguide")).distinct()), ["_a", "_b"]).select(*KEY, "bioguide")


def resolve(filings: DataFrame, members: DataFrame, terms: DataFrame, overrides: DataFrame) -> DataFrame:
    """``chamber, doc_id`` and the four identity columns of every filing.

    ``overrides``: ``chamber, filer_first, filer_last, state_district, member_id``; a null
    member says that the filer is none, and one that ``members`` lack ends the job.
    """
    f = prepared(filings)
    seat = F.coalesce("state_district", F.lit(""))
    known = members.select(F.col("bioguide").alias("member_id"), F.lit(True).alias("_known")).distinct()
    o = overrides.join(_sorted(known), "member_id", "left").select(
        F.concat_ws("|", S.name_key(F.col("chamber"), S.name_tokens(F.col("filer_last")), S.name_tokens(F.col("filer_first"))), seat).alias("_okey"),
        F.when(F.col("member_id").isNotNull() & F.col("_known").isNull(), F.raise_error(F.concat(F.lit("an override names an unknown member: "), "member_id"))).otherwise(F.col("member_id")).alias("_omember"),
        F.lit(True).alias("_override"),
    )
    shown = members.select(F.col("bioguide").alias("_id"), F.coalesce("official_full", F.concat_ws(" ", "first", "last")).alias("_full"))
    j = f.withColumn("_okey", F.concat_ws("|", "_name", seat)).join(o, "_okey", "left").join(matches(f, members, terms), KEY, "left")
    j = j.withColumn("_id", F.when(F.col("_override"), F.col("_omember")).otherwise(F.col("bioguide"))).join(_sorted(shown), "_id", "left")
    member = F.col("_full").isNotNull()
    return j.select(
        *KEY,
        F.when(member, F.concat(F.lit("member:"), "_id")).otherwise(F.col("_name")).alias("filer_key"),
        F.when(member, F.col("_id")).alias("member_id"),
        F.when(member, F.col("_full")).otherwise(F.col("_shown")).alias("display_name"),
        F.when(F.col("_override"), F.when(member, "override").otherwise("non_member")).when(member, "legislators").otherwise("unresolved").alias("identity_source"),
    )


def stale_overrides(overrides: DataFrame, filings: DataFrame) -> DataFrame:
    """``example`` for overrides whose proving filing no longer has the entry's name and seat."""
    key = lambda: F.concat_ws("|", S.name_key(F.col("chamber"), S.name_tokens(F.col("filer_last")), S.name_tokens(F.col("filer_first"))), F.coalesce("state_district", F.lit("")))
    a = overrides.select(*KEY, key().alias("_a"))
    b = filings.select(*KEY, key().alias("_b"))
    return a.join(b, KEY).where("_a <> _b").select(F.concat_ws(" ", F.concat_ws(":", *KEY), "_a").alias("example"))


def identify(rows: DataFrame, identities: DataFrame) -> DataFrame:
    """Rows stamped with their filing's identity; without one, the filed name as an unresolved filer."""
    named = S.name_key(F.col("chamber"), S.name_tokens(F.col("filer_last")), S.name_tokens(F.col("filer_first")))
    j = rows.drop(*IDENTITY).join(_sorted(identities), KEY, "left")
    return j.withColumns({
        "filer_key": F.coalesce("filer_key", named),
        "display_name": F.coalesce("display_name", S.display_name(F.col("filer_first"), F.col("filer_last"))),
        "identity_source": F.coalesce("identity_source", F.lit("unresolved")),
    })


def moved(before: DataFrame, after: DataFrame) -> DataFrame:
    """``chamber, doc_id`` of filings whose identity differs, nulls comparing equal."""
    same = F.struct(*[F.col(f"a.{c}") for c in IDENTITY]).eqNullSafe(F.struct(*[F.col(f"b.{c}") for c in IDENTITY]))
    return _sorted(before).alias("a").join(after.alias("b"), KEY).where(~same).select(*KEY)
