"""Figures out of tool logs: one row for each log line in (source, line_no, line), one row for each source out."""

from __future__ import annotations

import base64
import io
import json
import re
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lines_of(spark, path: str) -> DataFrame:
    """source and line of text files; undecodable bytes are replaced by the reader."""
    return spark.read.text(path).select(F.input_file_name().alias("source"), F.col("value").alias("line"))


def captured(pattern: str, group: int = 1, kind: str = "double") -> Column:
    """Aggregate: the number that the pattern captures in the lines, commas left out; the largest if several lines have one."""
    found = F.regexp_extract(F.col("line"), pattern, group)
    return F.max(F.regexp_replace(F.nullif(found, F.lit("")), "[,%]", "").try_cast(kind))


def trimming(lines: DataFrame) -> DataFrame:
    """Reads processed, with adapters, bases processed and trimmed."""
    return lines.groupBy("source").agg(
        captured(r"Total reads processed:\s+([\d,]+)").alias("total_reads"),
        captured(r"Reads with adapters:\s+([\d,]+)").alias("with_adapters"),
        captured(r"Total basepairs processed:\s+([\d,]+)").alias("total_bases"),
        captured(r"Quality-trimmed:\s+([\d,]+)").alias("trimmed_bases"),
    )


def flagstat(lines: DataFrame) -> DataFrame:
    """Total, mapped and properly paired reads, and the mapped share in percent."""
    out = lines.groupBy("source").agg(
        captured(r"^(\d+) \+ \d+ in total").alias("total"),
        captured(r"^(\d+) \+ \d+ mapped").alias("mapped"),
        captured(r"^(\d+) \+ \d+ properly paired").alias("proper"),
    )
    return out.withColumn("mapped_pct", F.when(F.col("total") > 0, 100 * F.col("mapped") / F.col("total")))


def alignment_stats(lines: DataFrame) -> DataFrame:
    """Summary numbers: first mates, mean length, mean quality and errors in percent."""
    sn = lambda name: captured(rf"^SN\t{name}:\t([-0-9.e+]+)")
    return lines.groupBy("source").agg(sn("1st fragments").alias("first_mates"), sn("average length").alias("mean_length"), sn("average quality").alias("mean_quality"), (100 * sn("error rate")).alias("error_pct"))


def duplicates(lines: DataFrame) -> DataFrame:
    """Duplicate share in percent: as written, else duplicates over twice the pairs."""
    out = lines.groupBy("source").agg(captured(r"([\d.]+)\s*% duplicates").alias("written"), captured(r"found ([\d,]+) duplicates").alias("found"), captured(r"sorted ([\d,]+) end pairs").alias("pairs"))
    return out.select("source", F.coalesce("written", F.when(F.col("pairs") > 0, 100 * F.col("found") / (2 * F.col("pairs")))).alias("dup_pct"))


def bias_bounds(lines: DataFrame) -> DataFrame:
    """The eight inclusion bounds of the original top and bottom strands, as texts."""
    get = lambda s: F.max(F.nullif(F.regexp_extract("line", rf"--{s}\s+([\d,]+)", 1), F.lit("")))
    return lines.groupBy("source").agg(get("OT").alias("top"), get("OB").alias("bottom"))


def metrics_block(lines: DataFrame, first_column: str) -> DataFrame:
    """source, metric, value of a header line that begins with ``first_column`` and the line below it (line_no orders lines)."""
    below = F.lead("line").over(Window.partitionBy("source").orderBy("line_no"))
    heads = lines.withColumn("values", below).where(F.col("line").startswith(first_column))
    pairs = F.arrays_zip(F.split("line", "\t").alias("metric"), F.split("values", "\t").alias("value"))
    return heads.select("source", F.explode(pairs).alias("p")).select("source", F.col("p")["metric"].alias("metric"), F.col("p")["value"].alias("value"))


def fastq_heads(lines: DataFrame) -> DataFrame:
    """Whether the first four lines of each source are a FASTQ record: source, read, valid."""
    four = lines.where("line_no < 4").groupBy("source").agg(*(F.max(F.when(F.col("line_no") == i, F.col("line"))).alias(f"l{i}") for i in range(4)))
    valid = F.col("l0").startswith("@") & F.col("l2").startswith("+") & (F.length("l1") == F.length("l3")) & (F.length("l1") > 0)
    return four.select("source", F.regexp_extract("l0", r"^@(\S+)", 1).alias("read"), F.coalesce(valid, F.lit(False)).alias("valid"))


def report_modules(files: DataFrame) -> DataFrame:
    """source, module, status of the summaries in zipped reports (path, content); 0 passed, 1 warned, 2 failed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in z.namelist():
                        if name.endswith("summary.txt"):
                            for line in z.read(name).decode("utf-8", "replace").splitlines():
                                status, module, *_ = [*line.split("\t"), ""]
                                rows.append((path, module, {"PASS": 0, "WARN": 1, "FAIL": 2}.get(status)))
            yield pd.DataFrame(rows, columns=["source", "module", "status"]).astype({"status": "Int64"})

    return files.select("path", "content").mapInPandas(run, "source string, module string, status long")


def failed_share(modules: DataFrame) -> DataFrame:
    """Share in percent of a report's modules that failed."""
    return modules.groupBy("source").agg((100 * F.count(F.when(F.col("status") == 2, 1)) / F.nullif(F.count("status"), F.lit(0))).alias("failed_pct"))


#: Letters of unpacked text at most; a longer one is no plot data.
LARGEST = 1 << 26


def unpack_lz(text: str, limit: int = LARGEST) -> str:
    """Text packed by the LZ-based packer for strings in base64, six bits to a letter, codes of growing width.

    Input that ends before its end mark, or unpacks to more than ``limit`` letters, is an error. Blanks are passed over.
    """
    turned = {c: int(f"{i & 63:06b}"[::-1], 2) for i, c in enumerate("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=")}
    text = "".join(text.split())
    at, held, n_held = 0, 0, 0

    def take(n: int) -> int:
        """The next n bits, the first of them the lowest."""
        nonlocal at, held, n_held
        while n_held < n:
            if at == len(text):
                raise ValueError("packed text ends early")
            if text[at] not in turned:
                raise ValueError("not base64")
            held |= turned[text[at]] << n_held
            at, n_held = at + 1, n_held + 6
        value = held & ((1 << n) - 1)
        held, n_held = held >> n, n_held - n
        return value

    def letter(code: int) -> str:
        return chr(take(8 if code == 0 else 16))

    if not text:
        return ""
    code = take(2)
    if code == 2:
        return ""
    if code > 2:
        raise ValueError("not packed text")
    known: list[str] = ["", "", "", letter(code)]
    last, out, width, room, size = known[3], [known[3]], 3, 4, 1
    while True:
        code = take(width)
        if code == 2:
            return "".join(out)
        if code < 2:
            known.append(letter(code))
            code, room = len(known) - 1, room - 1
            if room == 0:
                room, width = 1 << width, width + 1
        if code > len(known):
            raise ValueError("not packed text")
        entry = known[code] if code < len(known) else last + last[0]
        size += len(entry)
        if size > limit:
            raise ValueError("unpacked text is too long")
        out.append(entry)
        known.append(last + entry[0])
        last, room = entry, room - 1
        if room == 0:
            room, width = 1 << width, width + 1


def unpack(text: str) -> str:
    """Text packed by LZ or, as older pages have it, by gzip; anything else is an error."""
    if text.lstrip().startswith("H4sI"):
        packer = zlib.decompressobj(31)
        data = packer.decompress(base64.b64decode("".join(text.split()), validate=True), LARGEST)
        if not packer.eof:
            raise ValueError("packed text ends early or is too long")
        return data.decode()
    return unpack_lz(text)


def payload(html: str) -> dict:
    """The plot data inside a report page: the first payload that unpacks to a JSON object with something in it; else empty.

    Payloads stand in elements of their own; a page without such an element may have them as quoted base64. Quoted
    texts that begin neither as gzip nor with a packed brace, such as pictures, are passed over unread.
    """
    found = re.findall(r"""id=["']mqc_compressed_plotdata["'][^>]*>(.*?)</(?:script|div)""", html, re.DOTALL)
    for text in found or (t for t in re.findall(r'"([A-Za-z0-9+/=]{24,})"', html) if t.startswith(("H4sI", "N4"))):
        try:
            body = json.loads(unpack(text))
        except (ValueError, zlib.error, EOFError):  # not this kind of payload
            continue
        if isinstance(body, dict) and body:
            return body
    return {}


def plot_rows(pages: DataFrame) -> DataFrame:
    """source, plot, sample, category, value of the bar plots in report pages (path, html)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, html in zip(batch["path"], batch["html"], strict=True):
                for plot, body in payload(html or "").items():
                    for data in body.get("datasets", []):
                        for cat in data.get("cats", []):
                            rows += [(path, plot, s, cat["name"], float(v) if v is not None else None) for s, v in zip(data["samples"], cat["data"], strict=False)]
            yield pd.DataFrame(rows, columns=["source", "plot", "sample", "category", "value"])

    return pages.select("path", "html").mapInPandas(run, "source string, plot string, sample string, category string, value double")


def merge_plots(rows: DataFrame, order: str = "source") -> DataFrame:
    """One value for each plot, sample and category over several reports; the first report wins."""
    return rows.groupBy("plot", "sample", "category").agg(F.min_by("value", F.col(order)).alias("value"))
