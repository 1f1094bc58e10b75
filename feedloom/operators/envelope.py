"""Response envelopes: tell failed, empty and data responses apart, and take out records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, StringType, StructType

MALFORMED = "_malformed"
POLICIES = ("raise", "empty")
# What the JSON writer of a field taken as text allows; it cannot be raised.
MAX_DEPTH = 990
# The parser's own limits are lifted: a long text, number or nesting is no reason to lose a document.
PARSER = {
    "columnNameOfCorruptRecord": MALFORMED,
    "allowSingleQuotes": "false",
    **dict.fromkeys(("maxStringLen", "maxNumLen", "maxNestingDepth"), "2147483647"),
}


def answered() -> Column:
    """The response arrived with a non-error status."""
    return F.coalesce(F.col("status").between(200, 399), F.lit(False))


def parsed_body(field: str, element: DataType) -> Column:
    """The body as struct<documents: array<struct<field: array<element>>>, end, _malformed>.

    It is parsed as the one element of an array with a mark after it, so that neither no
    text nor text after the document's end passes for a sound document.
    """
    document = StructType().add(field, ArrayType(element))
    schema = (
        StructType().add("documents", ArrayType(document)).add("end", BooleanType()).add(MALFORMED, StringType())
    )
    wrapped = F.concat(F.lit('{"documents":['), "body", F.lit('],"end":true}'))
    return F.from_json(wrapped, schema, PARSER)


def first_document(parsed: Column) -> Column:
    return F.get(parsed["documents"], F.lit(0))


def single(parsed: Column) -> Column:
    """Nothing but one document, whatever its types."""
    return F.coalesce((F.size(parsed["documents"]) == 1) & parsed["end"], F.lit(False))


def sound(parsed: Column) -> Column:
    """One well-formed document, and all of it as the schema says."""
    return single(parsed) & first_document(parsed).isNotNull() & parsed[MALFORMED].isNull()


def failure_reason() -> Column:
    """Why a failed response failed: no_answer, status, or malformed."""
    return F.when(F.col("status").isNull(), "no_answer").when(~answered(), "status").otherwise("malformed")


def too_deep(body: Column | str) -> Column:
    """The text nests deeper than MAX_DEPTH, where a field that is taken as text cannot be written out.

    Costly, so it is asked of unreadable bodies only.
    """
    plain = F.regexp_replace(F.regexp_replace(body, r"(?s)\\.", ""), '"[^"]*"', "")
    brackets = F.split(F.regexp_replace(plain, r"[^\[\]{}]+", ""), "")

    def step(state: Column, bracket: Column) -> Column:
        depth = state["depth"] + F.when(bracket.isin("[", "{"), 1).when(bracket.isin("]", "}"), -1).otherwise(0)
        return F.struct(depth.alias("depth"), F.greatest(state["most"], depth).alias("most"))

    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("most"))
    return F.coalesce(F.aggregate(brackets, start, step, lambda state: state["most"]) > MAX_DEPTH, F.lit(False))


def classify(responses: DataFrame, field: str = "value") -> DataFrame:
    """The responses with their `outcome` and `reason`; those that have them already stay as they are.

    "failed" is no answer, an error status, or a body that is not one JSON object, and
    `reason` says which: no_answer, status, malformed, or over_limit for a body nested too
    deep to be read, which must stop a job and never count as lost. "empty" has no records
    under `field`, and the rest is "data".
    Records are not typed here: a mistyped field inside a record must not make its page
    look malformed.

    Classify when landing, and paging reads narrow columns instead of bodies.
    """
    if "outcome" in responses.columns:
        return responses
    parsed = responses.withColumn("_doc", F.when(answered(), parsed_body(field, StringType())))
    records = first_document(F.col("_doc"))[field]
    outcome = F.when(~sound(F.col("_doc")), "failed").when(F.size(records) > 0, "data").otherwise("empty")
    judged = parsed.select(*responses.columns, outcome.alias("outcome"))
    deep = answered() & (F.col("outcome") == "failed") & too_deep("body")
    reason = F.when(deep, "over_limit").otherwise(failure_reason())
    return judged.withColumn("reason", F.when(F.col("outcome") == "failed", reason))


def unnest(
    responses: DataFrame,
    element: StructType,
    field: str = "value",
    on_failure: str = "raise",
    strict: bool = True,
    seen: Observation | None = None,
) -> DataFrame:
    """(feed, record) with typed records: one parse, no shuffle.

    A failed response stops the job, or with on_failure="empty" gives no rows and is
    counted: `seen` then gets `responses`, and `no_answer`, `status` and `malformed` of
    them. A well-formed response is never lost: a mistyped record stops the job, or
    unless `strict` gets NULLs where it is mistyped, and a body nested too deep to be
    read stops it always.
    """
    if on_failure not in POLICIES:
        raise ValueError(f"on_failure must be one of {POLICIES}, not {on_failure!r}")
    parsed = responses.select(
        "feed", "body", failure_reason().alias("_reason"), F.when(answered(), parsed_body(field, element)).alias("_doc")
    )
    doc = F.col("_doc")
    records = first_document(doc)[field]
    readable = sound(doc)
    if not strict:
        readable = readable | (single(doc) & records.isNotNull())
    # Parsed again for unreadable bodies only: is the envelope sound, so that a record is at fault?
    mistyped = doc.isNotNull() & F.exists(F.array(parsed_body(field, StringType())), sound)
    if seen is not None:
        counts = [F.count_if(~readable & (F.col("_reason") == why)).alias(why) for why in ("no_answer", "status")]
        malformed = F.count_if(~readable & (F.col("_reason") == "malformed") & ~mistyped).alias("malformed")
        parsed = parsed.observe(seen, F.count(F.lit(1)).alias("responses"), *counts, malformed)
    stop = F.raise_error(F.concat(F.lit("mistyped record in the response of "), F.col("feed")))
    if on_failure == "raise":
        why = F.concat(F.lit(" ("), F.col("_reason"), F.lit(")"))
        on_failed = F.raise_error(F.concat(F.lit("failed response of "), F.col("feed"), why))
    else:
        on_failed = F.lit(None)
    limit = F.raise_error(F.concat(F.lit("response nested too deep (over_limit) of "), F.col("feed")))
    deep = doc.isNotNull() & too_deep("body")
    chosen = F.when(readable, records).when(mistyped, stop).when(deep, limit).otherwise(on_failed)
    return parsed.select("feed", F.explode(chosen).alias("record"))
