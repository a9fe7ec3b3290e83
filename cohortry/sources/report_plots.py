"""Plot data inside report pages: bars, lines and heat maps of every shape as rows, and several reports merged.

A task unpacks a page's payload; from there on it is a ``variant`` column, taken apart by expressions, so a payload may
have any plots and a plot any further fields. The older layout (lists of lists, values without positions, heat maps as
points) gives the same rows as the present one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.sources.logs import payload

#: What the numbers in a heat map of checks say.
STATUS = {1.0: "Pass", 0.5: "Warn", 0.25: "Fail"}


def payloads(pages: DataFrame) -> DataFrame:
    """``source`` and ``body`` (variant) of each page (path, html) with a payload that is not empty; the first of a page counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(path, json.dumps(found)) for path, html in zip(batch["path"], batch["html"], strict=True) if (found := payload(html or ""))]
            if rows:
                yield pd.DataFrame(rows, columns=["source", "text"])

    return pages.select("path", "html").mapInPandas(run, "source string, text string").select("source", F.parse_json("text").alias("body"))


def plots(found: DataFrame) -> DataFrame:
    """``source``, ``plot``, ``body``: one row for each plot of a payload that is an object."""
    each = found.alias("f").lateralJoin(found.sparkSession.tvf.variant_explode(F.col("f.body").outer()))
    rows = each.select("source", F.col("key").alias("plot"), F.col("value").alias("body"))
    return rows.where(F.schema_of_variant("body").startswith("OBJECT"))


def _get(value: str, path: str, kind: str) -> Column:
    return F.expr(f"try_variant_get({value}, '{path}', '{kind}')")


def _numbers(texts: Column) -> Column:
    return F.transform(texts, lambda x: x.try_cast("double"))


def _datasets(found: DataFrame) -> DataFrame:
    """A row for each dataset: ``dataset`` (its number), ``ds`` and whether it is an object of the present layout."""
    rows = found.select("source", "plot", "body", F.posexplode(_get("body", "$.datasets", "array<variant>")).alias("dataset", "ds"))
    return rows.withColumns({"kind": _get("body", "$.plot_type", "string"), "present": F.schema_of_variant("ds").startswith("OBJECT")})


def bars(found: DataFrame) -> DataFrame:
    """source, plot, dataset, category, category_ord, sample, sample_ord, value, pct of the bar plots among :func:`plots`.

    A category without a name is called by its number; a value that is no number, or is not there, is null.
    """
    old = ~F.col("present") & (F.col("kind") == "bar_graph")
    nested = F.schema_of_variant(_get("body", "$.samples[0]", "variant")).startswith("ARRAY")
    named = F.when(nested, F.get(_get("body", "$.samples", "array<array<string>>"), F.col("dataset"))).otherwise(_get("body", "$.samples", "array<string>"))
    rows = _datasets(found).withColumns({
        "cats": F.when(F.col("present"), _get("ds", "$.cats", "array<variant>")).when(old, _get("ds", "$", "array<variant>")),
        "samples": F.when(F.col("present"), _get("ds", "$.samples", "array<string>")).when(old, named),
    })
    cats = rows.select("source", "plot", "dataset", "samples", F.posexplode("cats").alias("category_ord", "cat"))
    cats = cats.withColumns({"category": F.coalesce(_get("cat", "$.name", "string"), F.col("category_ord").cast("string")), "data": _numbers(_get("cat", "$.data", "array<string>")), "share": _numbers(_get("cat", "$.data_pct", "array<string>"))})
    out = cats.select("source", "plot", "dataset", "category", "category_ord", "data", "share", F.posexplode("samples").alias("sample_ord", "sample"))
    return out.select("source", "plot", "dataset", "category", "category_ord", "sample", "sample_ord", F.get("data", F.col("sample_ord")).alias("value"), F.get("share", F.col("sample_ord")).alias("pct"))


def lines(found: DataFrame) -> DataFrame:
    """source, plot, dataset, label, line, line_ord, point, x_text, x, y of the line plots; M-bias contexts are the labels.

    Values without positions stand at the plot's categories if there are as many, else at 1, 2 and so on. ``x`` is null
    where a position is no number; ``x_text`` has it as written.
    """
    old = ~F.col("present") & (F.col("kind") == "xy_line")
    rows = _datasets(found).withColumns({
        "found": F.when(F.col("present"), _get("ds", "$.lines", "array<variant>")).when(old, _get("ds", "$", "array<variant>")),
        "label": F.coalesce(F.when(F.col("present"), _get("ds", "$.label", "string")), F.concat(F.lit("Dataset "), F.col("dataset") + F.when(old, 1).otherwise(0))),
        "places": _get("body", "$.config.categories", "array<string>"),
    })
    each = rows.select("source", "plot", "dataset", "label", "places", F.posexplode("found").alias("line_ord", "one"))
    each = each.withColumns({"line": F.coalesce(_get("one", "$.name", "string"), F.concat(F.lit("Sample "), "line_ord")), "pairs": F.coalesce(_get("one", "$.pairs", "array<variant>"), _get("one", "$.data", "array<variant>"))})
    points = each.select("source", "plot", "dataset", "label", "line", "line_ord", "places", F.size("pairs").alias("n"), F.posexplode("pairs").alias("point", "pair"))
    pair = F.schema_of_variant("pair").startswith("ARRAY")
    place = F.when(F.size("places") == F.col("n"), F.get("places", F.col("point"))).otherwise((F.col("point") + 1).cast("string"))
    x = F.when(pair, _get("pair", "$[0]", "string")).otherwise(place)
    y = F.when(pair, _get("pair", "$[1]", "string")).otherwise(_get("pair", "$", "string"))
    return points.select("source", "plot", "dataset", "label", "line", "line_ord", "point", x.alias("x_text"), x.try_cast("double").alias("x"), y.try_cast("double").alias("y"))


def heat_maps(found: DataFrame) -> DataFrame:
    """source, plot, dataset, x, x_ord, y, y_ord, value of the heat maps: every cell of a map has a row.

    Points of the older layout that are no three whole-number places and value, or lie outside, are passed over; of
    several for one cell the last counts, and a cell without any is 0.
    """
    present = _datasets(found).where("present")
    whole = present.select("source", "plot", "dataset", _get("ds", "$.xcats", "array<string>").alias("xs"), F.posexplode(F.arrays_zip(_get("ds", "$.ycats", "array<string>").alias("y"), _get("ds", "$.rows", "array<array<string>>").alias("row"))).alias("y_ord", "of"))
    cells = whole.where("of.y is not null").select("source", "plot", "dataset", F.col("of.y").alias("y"), "y_ord", F.col("of.row").alias("row"), F.posexplode("xs").alias("x_ord", "x"))
    cells = cells.select("source", "plot", "dataset", "x", "x_ord", "y", "y_ord", F.get("row", F.col("x_ord")).try_cast("double").alias("value"))
    old = found.where((_get("body", "$.plot_type", "string") == "heatmap") & F.expr("try_variant_get(body, '$.datasets', 'variant') is null"))
    empty = old.select("source", "plot", _get("body", "$.xcats", "array<string>").alias("xs"), F.posexplode(_get("body", "$.ycats", "array<string>")).alias("y_ord", "y"))
    empty = empty.select("source", "plot", "y", "y_ord", F.posexplode("xs").alias("x_ord", "x"))
    points = old.select("source", "plot", F.posexplode(_get("body", "$.data", "array<variant>")).alias("at", "p"))
    number = lambda i: F.when(F.schema_of_variant(F.expr(f"try_variant_get(p, '$[{i}]', 'variant')")) == "BIGINT", _get("p", f"$[{i}]", "int"))
    points = points.where("try_variant_get(p, '$[2]', 'variant') is not null").select("source", "plot", number(0).alias("x_ord"), number(1).alias("y_ord"), "at", _get("p", "$[2]", "string").try_cast("double").alias("value"))
    last = points.groupBy("source", "plot", "x_ord", "y_ord").agg(F.max_by("value", "at").alias("value"), F.lit(True).alias("set"))
    filled = empty.join(last, ["source", "plot", "x_ord", "y_ord"], "left").select("source", "plot", F.lit(0).alias("dataset"), "x", "x_ord", "y", "y_ord", F.when(F.col("set"), F.col("value")).otherwise(0.0).alias("value"))
    return cells.union(filled)


def status(cells: DataFrame, leave_out: Sequence[str] = ()) -> DataFrame:
    """Heat map cells with ``status`` (Pass, Warn, Fail or N/A), without the modules (x) named, letter case aside."""
    said = F.coalesce(F.element_at(F.create_map(*(F.lit(v) for pair in STATUS.items() for v in pair)), F.col("value")), F.lit("N/A"))
    kept = cells.where(~F.lower(F.trim("x")).isin([m.lower().strip() for m in leave_out])) if leave_out else cells
    return kept.withColumn("status", said)


def named(rows: DataFrame, plot: str) -> DataFrame:
    """Rows of one plot: under its own name, or else of each report under the first of that name with a dash and a number."""
    own = F.when(F.col("plot") == plot, F.lit("")).when(F.col("plot").startswith(f"{plot}-") & F.substring("plot", len(plot) + 2, 1 << 20).rlike("^[0-9]+$"), F.col("plot"))
    ranked = rows.withColumn("__own", own).where("__own is not null")
    return ranked.withColumn("__first", F.min("__own").over(Window.partitionBy("source"))).where("__own = __first").drop("__own", "__first")


def merged_bars(rows: DataFrame) -> DataFrame:
    """Bars of several reports as one plot each: plot, dataset, category, category_ord, source, sample, sample_ord, value, pct.

    Reports follow each other by ``source``, samples as they stand in each. Categories meet by name, in the order in
    which they first appear; a sample of a report without a category has a row with null values.
    """
    chart = ["plot", "dataset"]
    first = rows.groupBy(*chart, "category").agg(F.min(F.struct("source", "category_ord")).alias("first"))
    listed = first.groupBy(*chart).agg(F.sort_array(F.collect_list(F.struct("first", "category"))).alias("listed"))
    samples = rows.select(*chart, "source", "sample", F.col("sample_ord").alias("own_ord")).distinct()
    samples = samples.withColumn("sample_ord", F.row_number().over(Window.partitionBy(*chart).orderBy("source", "own_ord")) - 1)
    grid = samples.join(listed, chart).select(*chart, "source", "sample", "own_ord", "sample_ord", F.posexplode(F.col("listed")["category"]).alias("category_ord", "category"))
    values = rows.select(*chart, "source", F.col("sample_ord").alias("own_ord"), "category", "value", "pct")
    return grid.join(values, [*chart, "source", "own_ord", "category"], "left").select(*chart, "category", "category_ord", "source", "sample", "sample_ord", "value", "pct")


def merged_lines(rows: DataFrame) -> DataFrame:
    """Lines of several reports as one plot each, numbered anew by report and place; a dataset keeps its first label."""
    chart = ["plot", "dataset"]
    order = rows.select(*chart, "source", F.col("line_ord").alias("own_ord"), "label").distinct()
    by_report = Window.partitionBy(*chart).orderBy("source", "own_ord")
    order = order.withColumns({"line_ord": F.row_number().over(by_report) - 1, "label": F.first("label").over(by_report)})
    return rows.withColumnRenamed("line_ord", "own_ord").drop("label").join(order, [*chart, "source", "own_ord"]).drop("own_ord")


def merged_heat_maps(cells: DataFrame) -> DataFrame:
    """Heat maps of several reports as one each: rows (y) follow each other by report, columns (x) meet by name; gaps are null."""
    renamed = cells.withColumnsRenamed({"x": "category", "x_ord": "category_ord", "y": "sample", "y_ord": "sample_ord"}).withColumn("pct", F.lit(None).cast("double"))
    return merged_bars(renamed).withColumnsRenamed({"category": "x", "category_ord": "x_ord", "sample": "y", "sample_ord": "y_ord"}).drop("pct")
