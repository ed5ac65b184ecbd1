"""Imputation, encoding and scaling for training matrices.

Constants (medians, modes, means) are learned by distributed aggregates; only those constants,
one per column, come to the driver. They go into plain SQL stages, so a fitted pipeline can be
saved and loaded like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import (
    OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler,
)
from pyspark.sql import Column, DataFrame, functions as F

from seriesmill.operators.pages import with_position

#: Parts into which a pass over the values cuts the range of a wanted rank.
RANGES = 256
#: Rows up to which the different values of a column are counted in one aggregate.
FEW_ROWS = 16_384
MAX_TEXTS = 10_000
#: Columns per aggregate, so that generated code stays small.
AGGREGATES = 100


def _double(name: str) -> Column:
    return F.col(f"`{name}`").cast("double")


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median per column, the mean of the middle pair for even counts; only finite numbers count.

    Values are counted, never gathered: each pass cuts the range that holds a wanted rank into
    ``RANGES`` parts and keeps the part with the rank, as tight as its values are, until that part
    holds one value. A pass is an aggregate that combines before its shuffle and returns at most ``RANGES`` rows per
    wanted rank, two of a column. Tables of at most ``FEW_ROWS`` rows take one pass, which counts the values
    themselves. Columns without any value give ``None``.
    """
    names = list(columns)
    if names and df.count() <= FEW_ROWS:
        return _few_medians(df, names)
    extent = _ranges(df, [(c, None, None) for c in names])
    out: dict[str, float | None] = {}
    ends: dict[str, list[float]] = {c: [] for c in names}
    open_: dict[tuple[str, int], tuple[int, float, float]] = {}
    for i, c in enumerate(names):
        if i not in extent:
            out[c] = None
            continue
        (_, n, low, high), = extent[i]
        for rank in ((n - 1) // 2, n // 2):
            open_[c, rank] = (0, low, high)
            ends[c].append(rank)
    value: dict[tuple[str, int], float] = {}
    while open_:
        value |= {k: low for k, (_, low, high) in open_.items() if low == high}
        open_ = {k: v for k, v in open_.items() if v[1] < v[2]}
        brackets = sorted({(c, low, high) for (c, _), (_, low, high) in open_.items()})
        parts = _ranges(df, brackets) if brackets else {}
        for (c, rank), (below, low, high) in open_.items():
            for _, n, first, last in parts[brackets.index((c, low, high))]:
                if rank < below + n:
                    open_[c, rank] = (below, first, last)
                    break
                below += n
    return out | {c: (value[c, r[0]] + value[c, r[1]]) / 2 for c, r in ends.items() if r}


def _few_medians(df: DataFrame, names: Sequence[str]) -> dict[str, float | None]:
    """Exact medians from the counts of every value, a buffer per column; for tables of few rows."""
    out: dict[str, float | None] = {c: None for c in names}
    for at in range(0, len(names), AGGREGATES):
        cells = [f"named_struct('i', {i}, 'v', CAST(`{c}` AS DOUBLE))" for i, c in enumerate(names[at : at + AGGREGATES], at)]
        values = df.selectExpr(f"inline(array({', '.join(cells)}))").where("abs(v) < double('infinity')")
        out |= {names[r["i"]]: r["m"] for r in values.groupBy("i").agg(F.expr("percentile(v, 0.5)").alias("m")).collect()}
    return out


def _ranges(df: DataFrame, brackets: Sequence[tuple]) -> dict[int, list[tuple]]:
    """Per bracket (column, low, high) the parts with values, in order: (part, values, smallest, largest)."""
    cells = []
    for i, (c, low, high) in enumerate(brackets):
        v, part = f"CAST(`{c}` AS DOUBLE)", "0"
        if low is not None:
            # halves, so that no difference overflows
            share = f"({v} / 2 - {low / 2!r}D) / {high / 2 - low / 2!r}D" if high / 2 > low / 2 else f"IF({v} > {low!r}D, 1D, 0D)"
            inside = f"{v} BETWEEN {low!r}D AND {high!r}D"
            part = f"IF({inside}, CAST(floor(least({share}, 1D) * {RANGES - 1}) AS INT), 0)"
            v = f"IF({inside}, {v}, NULL)"
        cells.append(f"named_struct('i', {i}, 'part', {part}, 'v', {v})")
    found: dict[int, list[tuple]] = {}
    for at in range(0, len(cells), AGGREGATES):
        rows = (
            df.selectExpr(f"inline(array({', '.join(cells[at : at + AGGREGATES])}))")
            .where("abs(v) < double('infinity')")
            .groupBy("i", "part")
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            .collect()
        )
        for r in sorted(rows, key=lambda r: r["part"]):
            found.setdefault(r["i"], []).append((r["part"], r["n"], r["low"], r["high"]))
    return found


def text_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per column and text (``c``, ``v``, ``n``); counts combine before the shuffle."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns]
    )
    return (
        df.select(F.explode(cells).alias("s"))
        .where("s.v IS NOT NULL")
        .groupBy("s.c", "s.v")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def frequent_values(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent text per column, ties to the smallest."""
    out: dict[str, str | None] = {c: None for c in columns}
    if not columns:
        return out
    smallest = F.min(F.struct((-F.col("n")).alias("n"), "v"))
    rows = text_counts(df, columns).groupBy("c").agg(smallest.alias("b")).collect()
    return out | {r["c"]: r["b"]["v"] for r in rows}


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null numbers become the column's exact median; columns without values are left alone."""
    medians = {c: m for c, m in exact_medians(df, columns).items() if m is not None}
    return df.select(
        *[F.coalesce(_double(c), F.lit(medians[c])).alias(c) if c in medians else F.col(c) for c in df.columns]
    )


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null text becomes the column's most frequent value."""
    modes = frequent_values(df, columns)
    return df.na.fill({c: m for c, m in modes.items() if m is not None})


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zero mean and unit population deviation; a constant column is only centred."""
    means, devs = _mean_and_dev(df, {c: f"CAST(`{c}` AS DOUBLE)" for c in columns})
    return df.withColumns({c: (_double(c) - F.lit(means[c])) / F.lit(devs[c]) for c in columns})


def _mean_and_dev(df: DataFrame, exprs: dict[str, str]) -> tuple[dict, dict]:
    """Mean and population deviation per SQL expression; a deviation of zero counts as one."""
    means, devs, names = {}, {}, list(exprs)
    for at in range(0, len(names), AGGREGATES):
        some = names[at : at + AGGREGATES]
        row = df.agg(*[f(F.expr(exprs[c])) for c in some for f in (F.avg, F.stddev_pop)]).first() if some else ()
        means |= {c: row[2 * i] for i, c in enumerate(some)}
        devs |= {c: row[2 * i + 1] or 1.0 for i, c in enumerate(some)}
    return means, devs


def text_numbers(known: DataFrame, column: str) -> DataFrame:
    """(text, code) of the distinct texts in order, from 0; numbered without moving them to one task or the driver."""
    texts = known.select(F.col(f"`{column}`").cast("string").alias("__text")).where("__text IS NOT NULL").distinct()
    numbered = with_position(texts, ["__text"], "__code")
    return numbered.select("__text", (F.col("__code") - 1).cast("double").alias("__code"))


def _coded(df: DataFrame, numbers: DataFrame, column: str, output: str, unseen: float) -> DataFrame:
    text = F.col(f"`{column}`").cast("string")
    joined = df.join(numbers, text == F.col("__text"), "left")
    return joined.withColumn(output, F.coalesce(F.col("__code"), F.lit(unseen))).drop("__text", "__code")


def ordinal_codes(df: DataFrame, known: DataFrame, column: str, output: str) -> DataFrame:
    """Position of the text among the sorted values of ``known``; null and unseen text is -1."""
    return _coded(df, text_numbers(known, column), column, output, -1.0)


def one_hot(df: DataFrame, known: DataFrame, columns: Sequence[str], suffix: str = "_hot") -> DataFrame:
    """Indicator vector per column; null, and text not seen in ``known``, becomes the zero vector.

    Of the known texts only their number comes to the driver.
    """
    out, index, sizes = df, [f"{c}{suffix}_ix" for c in columns], []
    for c, ix in zip(columns, index):
        numbers = text_numbers(known, c)
        sizes.append(float(numbers.count()))
        out = _coded(out, numbers, c, ix, sizes[-1])
    # the encoder learns the sizes from one row; the last code, that of unseen text, is dropped
    widest = df.sparkSession.createDataFrame([tuple(sizes)], ", ".join(f"`{ix}` double" for ix in index))
    encoder = OneHotEncoder(inputCols=index, outputCols=[f"{c}{suffix}" for c in columns], dropLast=True).fit(widest)
    return encoder.transform(out).drop(*index)


def _hot_encoder(indexed: DataFrame, columns: Sequence[str], suffix: str = "_hot") -> Transformer:
    # widths come from the column metadata, no data is read
    return OneHotEncoder(
        inputCols=[f"{c}{suffix}_ix" for c in columns],
        outputCols=[f"{c}{suffix}" for c in columns],
        dropLast=True,
    ).fit(indexed)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Learned:
    """What the training rows say about the features: medians, and texts by falling frequency."""

    medians: dict[str, float]
    texts: dict[str, list[str]]

    @property
    def modes(self) -> dict[str, str]:
        return {c: found[0] for c, found in self.texts.items()}


def learn(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> Learned:
    """Constants shared by every encoding; features without a single value are left out.

    Each known text becomes a model input, so their number is limited by the model, and a column
    beyond ``MAX_TEXTS`` texts is an error.
    """
    medians = {c: m for c, m in exact_medians(train, numeric).items() if m is not None}
    texts: dict[str, list[str]] = {}
    if categorical:
        counts = text_counts(train, categorical)
        limit = MAX_TEXTS * len(categorical)
        rows = counts.orderBy("c", F.col("n").desc(), "v").limit(limit + 1).collect()
        for r in rows:
            texts.setdefault(r["c"], []).append(r["v"])
        wide = [c for c, found in texts.items() if len(found) > MAX_TEXTS]
        if wide or len(rows) > limit:
            raise ValueError(f"too many distinct texts for encoding: {wide or list(texts)}")
    return Learned(medians, {c: texts[c] for c in categorical if c in texts})


def preprocessing_stages(
    train: DataFrame,
    learned: Learned,
    encoding: str = "onehot",
    scale: bool = False,
    output: str = "features",
) -> list[Transformer]:
    """Fitted stages from raw features to one vector column; columns not learned are unused.

    Numbers: median for null, optional scaling. Text: most frequent value for null, then
    indicators (``onehot``) or codes (``ordinal``).
    """
    modes = learned.modes
    text = {c: f"COALESCE(CAST(`{c}` AS STRING), {_quoted(m)})" for c, m in modes.items()}
    number = {c: f"COALESCE(CAST(`{c}` AS DOUBLE), {m!r}D)" for c, m in learned.medians.items()}
    if scale and number:
        means, devs = _mean_and_dev(train, number)
        number = {c: f"({e} - {means[c]!r}D) / {devs[c]!r}D" for c, e in number.items()}
    made = {f"{c}__x": e for c, e in {**number, **text}.items()}
    fill = SQLTransformer(
        statement="SELECT *, " + ", ".join(f"{e} AS `{n}`" for n, e in made.items()) + " FROM __THIS__"
    )
    stages: list[Transformer] = [fill]
    inputs = [f"{c}__x" for c in number]
    if text:
        names = [f"{c}__x" for c in text]
        labels = [sorted(found) for found in learned.texts.values()]
        # one indexer per column: the multi-column constructor pads shorter label lists with nulls
        stages += [
            StringIndexerModel.from_labels(known, n, f"{n}_hot_ix", handleInvalid="keep")
            for n, known in zip(names, labels)
        ]
        if encoding == "onehot":
            stages.append(_hot_encoder(PipelineModel(stages).transform(train), names))
            inputs += [f"{n}_hot" for n in names]
        elif encoding == "ordinal":
            # plain numbers, -1 for unseen text: trees may then split on the order of the codes
            codes = ", ".join(
                f"CASE WHEN `{n}_hot_ix` = {len(known)} THEN -1D ELSE `{n}_hot_ix` END AS `{n}_code`"
                for n, known in zip(names, labels)
            )
            stages.append(SQLTransformer(statement=f"SELECT *, {codes} FROM __THIS__"))
            inputs += [f"{n}_code" for n in names]
        else:
            raise ValueError("encoding must be 'onehot' or 'ordinal'")
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="error"))
    return stages
