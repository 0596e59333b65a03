"""Regular-expression spans of whole texts by DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: (code points before the span, after its last one, the text in it)
SPANS = "array<struct<start:int,end:int,hit:string>>"


#: Pieces whose places are found in one go.
CHUNK = 256


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def span_type(context: int) -> str:
    return SPANS.replace("hit:string", "hit:string,before:string,after:string") if context else SPANS


def find_spans(text: Column, pattern: str, context: int = 0) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` (never empty ones) with
    their places. The pieces between matches and the matches themselves, in
    turn, give the places as running lengths: first of chunks of CHUNK pieces,
    then inside each, so that no list is copied span by span. With ``context``,
    spans also have the so many characters ``before`` and the one ``after``, which
    come from the pieces around them and not from the text by place."""
    pieces = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                        lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit"), F.coalesce(F.length(hit), F.lit(0)).alias("n"),
                                                  *([F.right(gap, F.lit(context)).alias("end"), F.left(gap, F.lit(1)).alias("first")] if context else [])))
    none = F.array().cast(span_type(context))

    def with_after(p: Column) -> Column:
        after = lambda b: F.when(b["first"] != "", b["first"]).otherwise(F.coalesce(F.left(b["hit"], F.lit(1)), F.lit("")))
        return F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), lambda a, b: F.struct(
            a["gap"].alias("gap"), a["hit"].alias("hit"), a["n"].alias("n"), a["end"].alias("end"), F.coalesce(after(b), F.lit("")).alias("after")))

    def tail(*parts: Column) -> Column:
        return F.right(F.concat(*parts), F.lit(context))

    def add(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + part["n"]
        fields = [start.alias("start"), end.alias("end"), part["hit"].alias("hit")]
        after = [end.alias("at")]
        if context:
            before = tail(state["tail"], part["end"])
            fields += [before.alias("before"), part["after"].alias("after")]
            after += [tail(before, part["hit"]).alias("tail")]
        return F.when(part["hit"].isNull(), state).otherwise(F.struct(*after, F.concat(state["out"], F.array(F.struct(*fields))).alias("out")))

    def places(p: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.floor((F.size(p) - 1) / CHUNK).cast("int"))
        chunk = lambda i: F.slice(p, i * CHUNK + 1, F.lit(CHUNK))
        lengths = F.transform(chunks, lambda i: F.aggregate(chunk(i), F.lit(0), lambda n, x: n + x["gap"] + x["n"]))
        starts = F.aggregate(lengths, F.array(F.lit(0)), lambda at, n: F.concat(at, F.array(F.element_at(at, -1) + n)))

        def begin(i: Column, at: Column) -> Column:
            fields = [at[i].alias("at")]
            if context:  # matches are not empty, so the last ``context`` pieces hold as many characters
                last = F.slice(p, F.greatest(F.lit(1), i * CHUNK - context + 1), F.least(i * CHUNK, F.lit(context)))
                fields += [F.aggregate(last, F.lit(""), lambda t, x: tail(t, x["end"], F.coalesce(x["hit"], F.lit("")))).alias("tail")]
            return F.struct(*fields, none.alias("out"))

        inside = lambda i, at: F.aggregate(chunk(i), begin(i, at), add, lambda state: state["out"])
        return let(starts, lambda at: F.flatten(F.transform(chunks, lambda i: inside(i, at))))

    return let(pieces, lambda p: let(with_after(p), places)) if context else let(pieces, places)


def spans_if(may: Column, text: Column, pattern: str, keep=None, context: int = 0) -> Column:
    """The spans of texts for which the cheap test ``may`` holds, filtered."""
    found = find_spans(text, pattern, context)
    found = F.filter(found, keep) if keep else found
    return F.when(may, found).otherwise(F.array().cast(span_type(context)))


def tagged(kinds: list[tuple[str, Column]], order: str) -> Column:
    """One sorted array of kind:start:end strings; ``order`` is "start" (then
    kind as listed) or "kind" (then start)."""

    def tag(n: int, kind: str, spans: Column) -> Column:
        def one(s: Column) -> Column:
            first, second = (s["start"], F.lit(n)) if order == "start" else (F.lit(n), s["start"])
            name = F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))
            return F.struct(first.alias("a"), second.alias("b"), s["end"].alias("c"), name.alias("t"))

        return F.transform(spans, one)

    every = F.concat(*[tag(n, kind, spans) for n, (kind, spans) in enumerate(kinds)])
    return F.transform(F.array_sort(every), lambda s: s["t"])


def mark_free(spans: DataFrame) -> DataFrame:
    """``spans`` (row, fixed, start, end, ...) with ``free``: whether the span
    overlaps no fixed span of its row but itself. Fixed spans before and after
    are met in two sorted passes, not span by span."""
    before = W.partitionBy("row").orderBy("start", F.col("fixed").desc(), "end").rowsBetween(W.unboundedPreceding, -1)
    after = W.partitionBy("row").orderBy(F.desc("start"), F.col("fixed"), F.desc("end")).rowsBetween(W.unboundedPreceding, -1)
    last_end, next_start = F.max(F.when(F.col("fixed"), F.col("end"))).over(before), F.min(F.when(F.col("fixed"), F.col("start"))).over(after)
    spans = spans.withColumns({"__last": last_end, "__next": next_start})
    free = (F.coalesce("__last", F.lit(0)) <= F.col("start")) & (F.coalesce("__next", F.col("end")) >= F.col("end"))
    return spans.withColumn("free", free).drop("__last", "__next")


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of ASCII digits passes the Luhn check."""
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.try_cast("int"))
                          .otherwise(F.when(c.try_cast("int") < 5, c.try_cast("int") * 2).otherwise(c.try_cast("int") * 2 - 9)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0
