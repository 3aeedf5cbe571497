"""Request contracts, batch scoring and priority ranks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.contracts import ContractError, ColumnContract, TableContract, require_columns
from tabloom.functions.clean import blank_to_null, trim_text
from tabloom.operators.learners import positive_probability
from tabloom.operators.lookup import left_lookup
from tabloom.operators.prefix import global_rank
from tabloom.scratch import materialize

REASONS = "reasons"
MAX_REQUEST_ROWS = 1_000
NUMERIC_KINDS = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)\z"


@dataclass(frozen=True)
class RequestContract:
    """Fields of one scoring request, in order, and the length of coded text."""

    fields: tuple[ColumnContract, ...]
    text_length: dict[str, tuple[int, int]]

    @property
    def names(self) -> list[str]:
        return [field.name for field in self.fields]


def request_contract(
    contract: TableContract, text_length: dict[str, tuple[int, int]] | None = None
) -> RequestContract:
    """Contract of the model features of a table contract."""
    by_name = {column.name: column for column in contract.columns}
    fields = tuple(by_name[name] for name in contract.features)
    return RequestContract(fields, text_length or {})


def _value_reasons(contract: RequestContract, field: ColumnContract, value: Column) -> list[Column]:
    """Broken value rules of one cleaned field; NULL where a rule holds."""
    name = field.name
    rules: list[Column] = []
    if field.required:
        rules.append(F.when(value.isNull(), F.lit(f"{name}:required")))
    if field.kind == "double":
        inside = ~F.isnan(value) & value.between(field.minimum, field.maximum)
        rules.append(F.when(~inside, F.lit(f"{name}:range")))
        return rules
    if name in contract.text_length:
        low, high = contract.text_length[name]
        rules.append(F.when(~F.length(value).between(low, high), F.lit(f"{name}:length")))
    if field.pattern:
        rules.append(F.when(~value.rlike(field.pattern), F.lit(f"{name}:domain")))
    if field.domain:
        rules.append(F.when(~value.isin(*field.domain), F.lit(f"{name}:domain")))
    return rules


def _reasons(rules: Sequence[Column]) -> Column:
    return F.array_sort(F.array_compact(F.array(*rules)))


def check_requests(df: DataFrame, contract: RequestContract) -> DataFrame:
    """Typed requests: clean every field and list its broken rules in ``reasons``."""
    require_columns(df, contract.names)
    values = [
        F.col(field.name) if field.kind == "double" else trim_text(F.col(field.name)).alias(field.name)
        for field in contract.fields
    ]
    trimmed = df.select(*[name for name in df.columns if name not in contract.names], _once(values))
    cleaned = _without_blanks(trimmed, contract)
    rules = [rule for field in contract.fields for rule in _value_reasons(contract, field, F.col(field.name))]
    return cleaned.withColumn(REASONS, _reasons(rules))


def _without_blanks(trimmed: DataFrame, contract: RequestContract) -> DataFrame:
    return trimmed.withColumns(
        {field.name: blank_to_null(F.col(field.name)) for field in contract.fields if field.kind != "double"}
    )


def _once(columns: Sequence[Column]) -> Column:
    """Compute columns once per row, as a generator of one row.

    A filter on results of the next steps is not pushed below a generator, so
    it cannot copy the parsing into every place that reads a field.
    """
    return F.inline(F.array(F.struct(*columns)))


def parse_requests(df: DataFrame, payload: str, contract: RequestContract) -> DataFrame:
    """JSON requests: typed fields and the broken rules in ``reasons``.

    Types are strict: a number must be a JSON number and a category a JSON
    string or null.  Unknown and missing fields are named.
    """
    others = list(df.columns)
    body = F.col("__body")
    parsed = df.withColumn("__body", F.try_parse_json(payload))
    read = parsed.select(
        *others,
        _once(
            [
                F.json_object_keys(F.col(payload)).alias("__keys"),
                body.isNotNull().alias("__valid"),
                *[
                    F.schema_of_variant(F.try_variant_get(body, f"$.{name}", "variant")).alias(f"__kind_{name}")
                    for name in contract.names
                ],
                *[
                    F.try_variant_get(
                        body, f"$.{field.name}", "double" if field.kind == "double" else "string"
                    ).alias(f"__value_{field.name}")
                    for field in contract.fields
                ],
            ]
        ),
    )
    values: list[Column] = []
    for field in contract.fields:
        kind, value = F.col(f"__kind_{field.name}"), F.col(f"__value_{field.name}")
        if field.kind == "double":
            good = kind.rlike(NUMERIC_KINDS)
            cleaned = F.when(good, value)
        else:
            good = kind == "STRING"
            cleaned = F.when(good, trim_text(value))
        values += [cleaned.alias(field.name), (good | (kind == "VOID")).alias(f"__typed_{field.name}")]
    kinds = [f"__kind_{name}" for name in contract.names]
    flat = _without_blanks(read.select(*others, "__keys", "__valid", *kinds, _once(values)), contract)

    known = F.array(*[F.lit(name) for name in contract.names])
    unknown = F.transform(F.array_except("__keys", known), lambda name: F.concat(name, F.lit(":unknown")))
    rules: list[Column] = []
    for field in contract.fields:
        name = field.name
        given, typed = F.col(f"__kind_{name}").isNotNull(), F.col(f"__typed_{name}")
        rules.append(F.when(~given, F.lit(f"{name}:missing")))
        rules.append(F.when(given & ~typed, F.lit(f"{name}:type")))
        # The type rule already covers a value that could not be read.
        rules += [F.when(given & typed, rule) for rule in _value_reasons(contract, field, F.col(name))]
    listed = F.array_sort(F.concat(F.array_compact(F.array(*rules)), unknown))
    is_object = F.col("__valid") & F.col("__keys").isNotNull()
    reasons = F.when(is_object, listed).otherwise(F.array(F.lit("body:not_an_object")))
    return flat.select(*others, *contract.names, reasons.alias(REASONS))


def checked_requests(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected requests, from rules that are evaluated once."""
    written = materialize(checked, "checked")
    return accepted(written), rejected(written)


def accepted(checked: DataFrame) -> DataFrame:
    """Requests without a broken rule."""
    return checked.where(F.size(REASONS) == 0).drop(REASONS)


def rejected(checked: DataFrame) -> DataFrame:
    """Requests with broken rules, for the reject sink."""
    return checked.where(F.size(REASONS) > 0)


def request_bounds(df: DataFrame, request: str, maximum: int = MAX_REQUEST_ROWS) -> DataFrame:
    """Rows per request and whether the number is within bounds."""
    return (
        df.groupBy(request)
        .agg(F.count("*").alias("n"))
        .withColumn("within_bounds", F.col("n").between(1, maximum))
    )


def judged_requests(
    checked: DataFrame, request: str, maximum: int = MAX_REQUEST_ROWS, broadcast_rows: int | None = None
) -> DataFrame:
    """``checked`` with reasons that concern whole requests added to ``reasons``.

    A request is taken or refused as a whole.  All its rows count, broken ones
    included: above ``maximum`` every row gets ``request:size``, and one broken
    row gives the others ``request:refused``.  Rows without a request id get
    ``request:key``.  No row is left out, and a huge request never meets in one
    task.  ``checked`` is read twice, so it should be a written table.
    """
    keyed = checked.where(F.col(request).isNotNull())
    sizes = keyed.groupBy(request).agg(
        F.count("*").alias("n"), (F.count_if(F.size(REASONS) > 0) > 0).alias("__flawed")
    )
    over = F.col("n") > maximum
    refused = materialize(
        sizes.where(over | F.col("__flawed")).select(request, "n", over.alias("__over")), "refused"
    )
    bound = {} if broadcast_rows is None else {"broadcast_rows": broadcast_rows}
    joined = left_lookup(keyed, refused, [request], "n", **bound)
    joined = joined.unionByName(checked.where(F.col(request).isNull()).withColumn("__over", F.lit(None).cast("boolean")))
    more = F.array_compact(
        F.array(
            F.when(F.col(request).isNull(), F.lit("request:key")),
            F.when(F.col("__over"), F.lit("request:size")),
            F.when(~F.col("__over") & (F.size(REASONS) == 0), F.lit("request:refused")),
        )
    )
    return joined.withColumn(REASONS, F.concat(REASONS, more)).select(*checked.columns)


def priority_rank(
    df: DataFrame, request: str, score: str, input_index: str, rank: str = "priority_rank"
) -> DataFrame:
    """Rank 1 for the lowest score of a request, ties in input order.

    Requests must be within bounds (``judged_requests``): one request is then
    at most MAX_REQUEST_ROWS rows.  For larger groups use ``global_rank``.
    """
    window = Window.partitionBy(request).orderBy(score, input_index)
    return df.withColumn(rank, F.row_number().over(window).cast("bigint"))


def rank_all(df: DataFrame, score: str, identifier: str, rank: str = "rank", parts: int | None = None) -> DataFrame:
    """Rank of every row of a table by score, ties by identifier."""
    return global_rank(df, [F.col(score), F.col(identifier)], rank=rank, parts=parts)


def score_sanity(df: DataFrame, score: str) -> DataFrame:
    """Rows, and scores that are missing, not finite or outside [0, 1]."""
    value = F.col(score)
    finite = ~F.isnan(value) & (F.abs(value) < float("inf"))
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(value.isNull()).alias("missing"),
        F.count_if(value.isNotNull() & ~finite).alias("not_finite"),
        F.count_if(finite & ~value.between(0, 1)).alias("out_of_range"),
    )


def require_sane_scores(scored: DataFrame, score: str, expected_rows: int) -> None:
    """Raise when the model lost rows or returned unusable probabilities."""
    row = score_sanity(scored, score).first()
    if row["rows"] != expected_rows:
        raise ContractError(f"model returned {row['rows']} rows for {expected_rows} requests")
    broken = [name for name in ("missing", "not_finite", "out_of_range") if row[name]]
    if broken:
        raise ContractError("model returned unusable probabilities: " + ", ".join(broken))


def score_rows(df: DataFrame, model: PipelineModel, score: str = "p") -> DataFrame:
    """Positive probability and its complement; scores come as number or vector."""
    scored = model.transform(df)
    kind = scored.schema["probability"].dataType.simpleString()
    value = F.col("probability") if kind == "double" else positive_probability()
    return scored.select(*df.columns, value.alias(score), (F.lit(1.0) - value).alias("complement"))


def score_batch(
    checked: DataFrame,
    model: PipelineModel,
    request: str,
    input_index: str,
    maximum: int = MAX_REQUEST_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Scored and rejected rows of checked requests; together they are all rows.

    Rows of accepted requests are scored and ranked inside their request.  Both
    tables are written, and the scores are judged, before anything is returned.
    Rows without a ``reasons`` column count as checked without a finding.
    """
    if REASONS not in checked.columns:
        checked = checked.withColumn(REASONS, F.array().cast("array<string>"))
    judged = materialize(judged_requests(materialize(checked, "checked"), request, maximum), "judged")
    good = accepted(judged)
    scored = materialize(priority_rank(score_rows(good, model), request, "p", input_index), "scored")
    require_sane_scores(scored, "p", good.count())
    return scored, rejected(judged)
