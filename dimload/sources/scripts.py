"""SQL scripts with parameters (S5), views from scripts (S6), refresh a table.

Layer names (``{core}``, ``{staging}``, ...) are identifiers and are substituted as text after
checking they are plain identifiers; every *value* is bound with Spark's named parameters
(``:name``), never pasted into the text.
"""

from __future__ import annotations

import re
from pathlib import Path
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_.]*$")


def load_script(folder: str, stage: str, name: str) -> str:
    """Text of ``<folder>/<stage>/<name>.sql``."""
    return Path(folder, stage, f"{name}.sql").read_text()


def render_script(text: str, layers: Mapping[str, str] | None = None, positional: tuple = ()) -> str:
    """Substitute ``{0}``... and ``{layer}`` identifiers; anything that is not an identifier is refused."""
    layers = dict(layers or {})
    for v in list(layers.values()) + list(positional):
        if not _IDENT.match(str(v)):
            raise ValueError(f"not an identifier: {v!r}")
    return text.format(*positional, **layers)


#: What a statement is made of: quoted text and names (a doubled quote stays inside, a backslash takes
#: the next character along), comments to the line's end, bracketed ones, the end of it, anything else.
_PIECES = re.compile(
    r"""'(?:[^'\\]|\\.|'')*' | "(?:[^"\\]|\\.|"")*" | `(?:[^`]|``)*` | --[^\n]* | /\*.*?\*/ | (?P<end>;) | .""",
    re.DOTALL | re.VERBOSE,
)


def statements(text: str) -> list[str]:
    """A script's statements, separated by ``;`` outside of quotes and comments; the last one may omit it.
    A statement of comments only is none."""
    out, bare, start = [], "", 0
    for piece in _PIECES.finditer(text):
        if piece["end"]:
            out.append((bare, text[start : piece.start()]))
            bare, start = "", piece.end()
        elif not piece[0].startswith(("--", "/*")):
            bare += piece[0]
    out.append((bare, text[start:]))
    return [body.strip() for code, body in out if code.strip()]


def _parameters(sql: str) -> set[str]:
    """The names after ``:`` outside of quotes and comments."""
    code = "".join(" " if piece[0][0] in "'\"`" or piece[0].startswith(("--", "/*")) else piece[0] for piece in _PIECES.finditer(sql))
    return set(re.findall(r":(\w+)", code))


def run_script(
    spark: SparkSession,
    text: str,
    args: Mapping[str, object] | None = None,
    layers: Mapping[str, str] | None = None,
    positional: tuple = (),
) -> DataFrame:
    """Run a SQL script with layer names substituted and values bound as parameters. All of its
    statements run in order; the result of the last one is returned."""
    out = None
    for sql in statements(render_script(text, layers, positional)):
        used = {k: v for k, v in (args or {}).items() if k in _parameters(sql)}
        out = spark.sql(sql, args=used) if used else spark.sql(sql)
    if out is None:
        raise ValueError("the script has no statement")
    return out


def view_from_script(
    spark: SparkSession,
    name: str,
    text: str,
    args: Mapping[str, object] | None = None,
    layers: Mapping[str, str] | None = None,
    drop_first: bool = False,
    permanent: bool = False,
) -> DataFrame:
    """Create-or-replace a view from a script; returns the view's DataFrame.

    Temporary by default. A ``permanent`` view is stored in the catalog (``name`` may be
    ``database.view``); its script is one query over catalog tables and takes no bound values.
    """
    if not all(_IDENT.match(part) for part in name.split(".")) or ("." in name and not permanent):
        raise ValueError(f"not an identifier: {name!r}")
    if permanent:
        body = statements(render_script(text, layers))
        if args or len(body) != 1:
            raise ValueError("a permanent view is one query without bound values")
        if drop_first:
            spark.sql(f"DROP VIEW IF EXISTS {name}")
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {body[0]}")
        return spark.table(name)
    if drop_first:
        spark.catalog.dropTempView(name)
    df = run_script(spark, text, args, layers)
    df.createOrReplaceTempView(name)
    return spark.table(name)


def refresh_table(target: DataFrame | None, source: DataFrame) -> DataFrame:
    """The rows a refresh writes -- the source projected onto the target's columns
    (case-insensitive, target order and types), or the source as it is when there is no target."""
    from pyspark.sql import functions as F

    if target is None:
        return source
    src = {c.lower(): c for c in source.columns}
    cols = []
    for f in target.schema.fields:
        s = src.get(f.name.lower())
        cols.append((F.col(f"`{s}`") if s else F.lit(None)).cast(f.dataType).alias(f.name))
    return source.select(*cols)


def refresh_into(source: DataFrame, target_path: str) -> DataFrame:
    """S8 on storage: the table at ``target_path`` emptied and filled with the source's rows in its
    own columns, or created from the source when there is none. If it fails, the table is as it was."""
    from dimload.sources.versions import read_or_none, replace_table

    target = read_or_none(source.sparkSession, target_path)
    return replace_table(refresh_table(target, source), target_path)
