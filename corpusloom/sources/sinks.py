"""Sinks beside Parquet: sidecar pairs, manifests, summaries, arrays, pages of HTML, and dense matrices as a source.

All paths are URIs or local paths; files are written through Arrow's file systems, so a folder that all executors share works from
any of them. Only small results (a summary, a matrix of groups, the points of a chart) are written by the driver.
"""

from __future__ import annotations

import html
import io
import json
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A chart or matrix is drawn by the driver from at most so many rows.
MOST_DRAWN = 200_000


def _place(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def write_file(path: str, content: bytes | str) -> str:
    """Write one file, replacing it; missing folders are made."""
    system, inner = _place(path)
    system.create_dir(inner.rpartition("/")[0] or ".", recursive=True)
    with system.open_output_stream(inner) as f:
        f.write(content.encode() if isinstance(content, str) else content)
    return path


def read_file(path: str) -> bytes:
    system, inner = _place(path)
    with system.open_input_stream(inner) as f:
        return f.read()


def write_sidecars(df: DataFrame, folder: str, key: str = "id", text: str = "text") -> int:
    """A ``<key>.txt`` and a ``<key>.json`` of all other columns for every record; the number of records written.

    Records are written where they are; a task that is run again writes the same files. Records without a text get no
    pair, null fields leave, a slash in a key becomes an underscore."""
    rest = [c for c in df.columns if c != text]
    name = F.regexp_replace(F.col(key).cast("string"), "[/\\\\]", "_")
    rows = df.where(F.col(key).isNotNull() & (F.col(text) != "")).select(name.alias("name"), F.col(text).alias("text"), F.to_json(F.struct(*rest)).alias("meta"))

    def write(batches: Iterable[pd.DataFrame]):
        n = 0
        for pdf in batches:
            for stem, t, meta in zip(pdf["name"], pdf["text"], pdf["meta"]):
                write_file(f"{folder.rstrip('/')}/{stem}.txt", t)
                write_file(f"{folder.rstrip('/')}/{stem}.json", meta)
            n += len(pdf)
        yield pd.DataFrame({"n": [n]})

    return rows.mapInPandas(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


#: Fields of a record's metadata with what they hold where nothing is known.
METADATA_DEFAULTS = {"title": "", "author": "unknown", "tradition": "unknown", "source": "", "source_url": "", "file_type": ""}


def with_metadata(records: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """Records with the metadata fields, taken from ``manifest_*`` columns (as a manifest look-up gives them) where the record has none,
    else the defaults."""
    df = records if manifest is None else records.join(manifest.select("id", *[F.col(c).alias(f"manifest_{c}") for c in manifest.columns if c in METADATA_DEFAULTS]), "id", "left")
    for c, default in METADATA_DEFAULTS.items():
        have = [F.col(x) for x in (c, f"manifest_{c}") if x in df.columns]
        df = df.withColumn(c, F.coalesce(*have, F.lit(default)))
    return df.drop(*[f"manifest_{c}" for c in METADATA_DEFAULTS])


def write_manifest(state: DataFrame, path: str, key: str = "item_id") -> str:
    """One JSON object ``{"items": {key: fields}}`` of the newest state of a source; entries are strings the driver joins, one an item."""
    rest = [c for c in state.columns if c != key]
    rows = state.where(F.col(key).isNotNull()).select(key, F.to_json(F.struct(*rest)).alias("j")).orderBy(key).toLocalIterator()
    return write_file(path, '{"items": {' + ", ".join(f"{json.dumps(r[key])}: {r['j']}" for r in rows) + "}}")


def write_summary(summary: dict, path: str) -> str:
    return write_file(path, json.dumps(summary, indent=2, ensure_ascii=False, sort_keys=True))


def write_array(values: np.ndarray, path: str) -> str:
    out = io.BytesIO()
    np.save(out, values, allow_pickle=False)
    return write_file(path, out.getvalue())


def write_matrix(matrix: DataFrame, path: str, a: str = "a", b: str = "b", value: str = "sim") -> list:
    """A square matrix of groups as an array file; the groups in the order of its rows."""
    pdf = matrix.select(a, b, value).limit(MOST_DRAWN + 1).toPandas()
    if len(pdf) > MOST_DRAWN:
        raise ValueError(f"a matrix of more than {MOST_DRAWN} cells is no result for one file")
    wide = pdf.pivot(index=a, columns=b, values=value).sort_index().sort_index(axis=1)
    write_array(wide.to_numpy(float), path)
    return wide.index.tolist()


def load_matrix(spark: SparkSession, path: str, ids: list | None = None, parts: int | None = None) -> DataFrame:
    """(row, vector[, id]) of a dense array file of one row a vector; the file is read by ranges of rows in the tasks, not by the driver."""
    system, inner = _place(path)
    with system.open_input_file(inner) as f:
        version = np.lib.format.read_magic(f)
        shape, fortran, kind = (np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0)(f)
        start = f.tell()
    if len(shape) != 2 or fortran or kind.hasobject:
        raise ValueError("a dense two-dimensional array in row order is needed")
    rows, dims = shape
    parts = parts or max(1, min(rows, spark.sparkContext.defaultParallelism))

    def read(batches):
        for pdf in batches:
            for a, b in zip(pdf["a"], pdf["b"]):
                s, p = _place(path)
                with s.open_input_file(p) as f:
                    for at in range(a, b, 4096):
                        n = min(4096, b - at)
                        x = np.frombuffer(f.read_at(n * dims * kind.itemsize, start + at * dims * kind.itemsize), kind).reshape(n, dims)
                        yield pd.DataFrame({"row": np.arange(at, at + n), "vector": list(x.astype(np.float32))})

    cuts = np.linspace(0, rows, parts + 1).astype(int).tolist()
    ranges = spark.createDataFrame(list(zip(cuts[:-1], cuts[1:])), "a long, b long").repartition(parts)
    out = ranges.mapInPandas(read, "row long, vector array<float>")
    return out if ids is None else out.join(spark.createDataFrame(list(enumerate(ids)), ["row", "id"]), "row")


def scatter_page(points: DataFrame, path: str, color_by: str, title: str = "") -> str:
    """A page of HTML with the points (x, y) as a drawing, coloured by a column, other columns as tips."""
    pdf = points.limit(MOST_DRAWN + 1).toPandas()
    if len(pdf) > MOST_DRAWN:
        raise ValueError(f"at most {MOST_DRAWN} points can be drawn")
    hue = {g: int(360 * i / max(1, pdf[color_by].nunique(dropna=False))) for i, g in enumerate(sorted(pdf[color_by].unique(), key=str))}
    span = lambda c: (pdf[c] - pdf[c].min()) / ((pdf[c].max() - pdf[c].min()) or 1)
    x, y = (20 + 960 * span("x"), 680 - 660 * span("y")) if len(pdf) else ([], [])
    tips = [c for c in pdf.columns if c not in ("x", "y", "z")]
    dots = "".join(
        f'<circle cx="{a:.1f}" cy="{b:.1f}" r="3" fill="hsl({hue[r[color_by]]},60%,45%)"><title>{html.escape("; ".join(f"{c}: {str(r[c])[:200]}" for c in tips))}</title></circle>'
        for a, b, r in zip(x, y, pdf.to_dict("records"))
    )
    legend = "".join(f'<li style="color:hsl({h},60%,35%)">{html.escape(str(g))}</li>' for g, h in hue.items())
    return write_file(path, f'<!DOCTYPE html><meta charset="utf-8"><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1><svg viewBox="0 0 1000 700">{dots}</svg><ul>{legend}</ul>')


def heatmap_page(matrix: DataFrame, path: str, a: str = "a", b: str = "b", value: str = "value", title: str = "") -> str:
    """A page of HTML with a square matrix of groups as a coloured table."""
    pdf = matrix.select(a, b, value).limit(MOST_DRAWN + 1).toPandas()
    if len(pdf) > MOST_DRAWN:
        raise ValueError(f"at most {MOST_DRAWN} cells can be drawn")
    wide = pdf.pivot(index=a, columns=b, values=value).sort_index().sort_index(axis=1)
    cell = lambda v: "<td></td>" if pd.isna(v) else f'<td style="background:hsl(220,70%,{95 - 50 * min(1, max(0, (v + 1) / 2)):.0f}%)">{v:.3f}</td>'
    head = "<tr><th></th>" + "".join(f"<th>{html.escape(str(c))}</th>" for c in wide.columns) + "</tr>"
    body = "".join(f"<tr><th>{html.escape(str(g))}</th>{''.join(map(cell, wide.loc[g]))}</tr>" for g in wide.index)
    return write_file(path, f'<!DOCTYPE html><meta charset="utf-8"><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1><table>{head}{body}</table>')
