"""Target lines to target molecules, with the refused lines kept apart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from simmart.functions.fingerprint import is_structure, structure_fault
from simmart.functions.text import has_non_ascii, is_blank, strip
from simmart.operators.dedup import keep_first

# Lines dropped without being reported.
SILENT = ["header", "blank"]


def line_reason(line: Column, content: Column) -> Column:
    """Why a line gives no molecule; null when it gives one.

    In this order: header, blank, no comma, a character past ASCII, a further
    comma after the first. An empty second part is kept.
    """
    rest = F.get(F.split(content, ",", 2), F.lit(1))
    return (
        F.when(line == 1, "header")
        .when(is_blank(content), "blank")
        .when(rest.isNull(), "malformed")
        .when(has_non_ascii(content), "non-ascii")
        .when(strip(rest).contains(","), "extra comma")
    )


def judged_lines(lines: DataFrame) -> DataFrame:
    """Lines with the reason they give no molecule, or null."""
    return lines.withColumn("reason", line_reason(F.col("line"), F.col("content")))


def observed_lines(lines: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Numbered lines, and what the next action on them counts: files, lines,
    lines that give a molecule, and those that are silent or refused."""
    seen, reason = Observation(name), line_reason(F.col("line"), F.col("content"))
    counts = {
        "files": F.col("line") == 1,
        "lines": F.lit(True),
        "molecule lines": reason.isNull(),
        "silent lines": F.coalesce(reason.isin(SILENT), F.lit(False)),
        "refused lines": F.coalesce(~reason.isin(SILENT), F.lit(False)),
    }
    return lines.observe(seen, *(F.count_if(test).alias(what) for what, test in counts.items())), seen


def molecules(lines: DataFrame) -> DataFrame:
    """(file, line, chembl_id, smiles) of the accepted lines."""
    parts = F.split(F.col("content"), ",", 2)
    return (
        judged_lines(lines)
        .where("reason is null")
        .select("file", "line", strip(parts[0]).alias("chembl_id"), strip(parts[1]).alias("smiles"))
    )


def refused_lines(lines: DataFrame) -> DataFrame:
    """(file, line, reason, content) of the lines worth a warning."""
    judged = judged_lines(lines).where(F.col("reason").isNotNull() & ~F.col("reason").isin(SILENT))
    return judged.select("file", "line", "reason", "content")


def monthly_targets(lines: DataFrame) -> DataFrame:
    """(chembl_id, smiles): accepted molecules, the first of each id in file
    and line order."""
    return keep_first(molecules(lines), ["chembl_id"], ["file", "line"]).select("chembl_id", "smiles")


def accepted_targets(targets: DataFrame, valid: Callable[[Column], Column] = is_structure) -> DataFrame:
    """Targets whose structure string is accepted."""
    return targets.where(valid(F.col("smiles")))


def refused_targets(targets: DataFrame, fault: Callable[[Column], Column] = structure_fault) -> DataFrame:
    """Targets whose structure string is refused, with the reason."""
    return targets.withColumn("reason", fault(F.col("smiles"))).where("reason is not null")
