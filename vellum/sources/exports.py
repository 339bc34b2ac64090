"""Writers of the dataset types: CSV, JSON array, JSON lines, image manifests and a text manifest."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions.ids import shard_path
from vellum.operators.harmonize import Levels
from vellum.plans.query import DatasetBuilder
from vellum.sources.projections import article_metadata, case_series_table, case_table, citations, fields_of, image_table, with_image_tokens
from vellum.storage import forget, new_path

DATASET_TYPES = ("text", "image", "multimodal", "case_series")


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def guard_name(spark: SparkSession, path: str) -> None:
    """Refuse a dataset folder that exists."""
    fs, target = _fs(spark, path)
    if fs.exists(target):
        raise ValueError(f"{path} exists already")


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV parts with headers, written in parallel; lists become JSON text."""
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.csv(path, header=True, quote='"', escape='"')


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.json(path)


def write_json_array(df: DataFrame, path: str) -> None:
    """One file that is one JSON array, as reference lists are exchanged.

    Tasks write the rows as JSON, each behind a comma; the driver then copies the finished parts
    into one file through a small buffer, without the first comma, and puts the brackets around them.
    """
    spark = df.sparkSession
    parts = new_path(spark, "json-parts")
    rows = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    df.select(F.concat(F.lit(","), rows).alias("value")).write.text(parts)
    fs, target = _fs(spark, path)
    source, folder = _fs(spark, parts)
    out, begun = fs.create(target), False
    try:
        out.write(bytearray(b"["))
        files = [s.getPath() for s in source.listStatus(folder) if s.getLen() > 0 and s.getPath().getName().startswith("part-")]
        for file in sorted(files, key=lambda f: f.getName()):
            stream = source.open(file)
            if not begun:
                stream.skip(1)
                begun = True
            spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, False)
            stream.close()
        out.write(bytearray(b"]"))
    finally:
        out.close()
        forget(spark, parts)


def image_manifest(images: DataFrame, folder: str, per_case: bool = False) -> DataFrame:
    """source and target of each file to copy: two folder levels of its name, and in them the file or a folder for each case.

    In a case's folder the article's key at the beginning of the file's name gives way to the folder.
    """
    file = F.col("file")
    if per_case:
        file = F.replace(file, F.concat(F.substring_index("case_id", "_", 1), F.lit("_")), F.concat("case_id", F.lit("/")))
    path = F.concat_ws("/", F.lit(folder), F.substring("file", 1, 4), F.substring("file", 1, 5), file)
    return images.select("file", F.col("file_path").alias("source"), path.alias("target"))


def copy_files(manifest: DataFrame) -> DataFrame:
    """Copy the manifest's files by the tasks; one status row per file. Paths are local or mounted on all executors."""
    import shutil
    from pathlib import Path

    import pyarrow as pa

    def run(batches):
        for b in batches:
            status = []
            for s, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    Path(t).parent.mkdir(parents=True, exist_ok=True)
                    shutil.copyfile(s, t)
                    status.append("ok")
                except FileNotFoundError:
                    status.append("image-not-found")
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(status, pa.string())], names=["target", "status"])

    return manifest.select("source", "target").mapInArrow(run, "target string, status string")


def readme(name: str, dataset_type: str, filters: list[dict], version: str, now: datetime | None = None) -> str:
    lines = [f"Dataset name: {name}", f"Dataset type: {dataset_type}", f"Creation date: {(now or datetime.now()):%Y-%m-%d}", f"Version: {version}", "Filters:"]
    return "\n".join(lines + [f"  {f}" for f in filters]) + "\n"


def export(levels: Levels, path: str, dataset_type: str, filters: list[dict], name: str, version: str = "", all_images: DataFrame | None = None, image_token: str | None = None, label_columns: list[str] = (), copy_images: bool = False) -> None:
    """Write a reconciled dataset: citations, article metadata and readme always, cases and images by type.

    Levels have the clinical columns; those they lack are null. ``all_images`` are the images
    whose mentions become tokens in the cases of a multimodal dataset. With ``copy_images`` the
    files are copied from their file_path, and ``image_status`` says what became of each.
    """
    if dataset_type not in DATASET_TYPES:
        raise ValueError(f"dataset_type must be one of {DATASET_TYPES}")
    spark = levels.articles.sparkSession
    guard_name(spark, path)
    write_json_array(citations(levels.articles), f"{path}/case_report_citations.json")
    write_json_array(article_metadata(levels.articles), f"{path}/article_metadata.json")
    cases = case_table(levels.cases)
    if dataset_type == "multimodal" and all_images is not None:
        cases = with_image_tokens(cases, all_images, token=image_token)
    if dataset_type in ("text", "multimodal"):
        write_csv(cases, f"{path}/cases.csv")
    if dataset_type == "case_series":
        write_csv(case_series_table(levels.cases, levels.images), f"{path}/cases.csv")
    if dataset_type in ("image", "multimodal"):
        write_json_lines(image_table(levels.images, path, list(label_columns)), f"{path}/image_metadata.json")
    if dataset_type != "text":
        manifest = image_manifest(levels.images, f"{path}/images", dataset_type == "case_series")
        manifest.write.parquet(f"{path}/image_manifest")
        if copy_images:
            copy_files(spark.read.parquet(f"{path}/image_manifest")).write.parquet(f"{path}/image_status")
    _write_text(spark, f"{path}/readme.txt", readme(name, dataset_type, filters, version))


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _fs(spark, path)
    out = spark._jvm.java.io.OutputStreamWriter(fs.create(target), "UTF-8")
    out.write(text)
    out.close()


#: The label columns that a classification table keeps on request.
LABEL_COLUMNS = ["image_type", "image_subtype", "radiology_region", "radiology_region_granular", "radiology_view", "ml_labels_for_supervised_classification", "gt_labels_for_semisupervised_classification"]


def classification_table(builder: DatasetBuilder, folder: str, common: list[dict], classes: dict[str, list[dict]], label_filter_column: str = "both", keep_label_columns: bool = False) -> DataFrame:
    """file_id, file, file_path, class, and the label columns where they are kept: the images of each class.

    A class has the images under the common and its own filters; files of several classes are dropped. The
    path is in the class's own dataset, ``<folder>_<class>``. Columns that the images lack are null.
    """
    images = builder.classification(common, classes, "file", label_filter_column)
    path = F.concat(F.lit(f"{folder}_"), F.col("class"), F.lit("/images/"), shard_path(F.col("file")))
    return fields_of(images.withColumn("file_path", path), ["file_id", "file", "file_path", "class", *(LABEL_COLUMNS if keep_label_columns else [])])


def export_classification(builder: DatasetBuilder, directory: str, name: str, common: list[dict], classes: dict[str, list[dict]], label_filter_column: str = "both", keep_label_columns: bool = False, version: str = "", copy_images: bool = False) -> None:
    """An image dataset for each class in ``<directory>/<name>_<class>``, and in ``<directory>/<name>`` a CSV of all classes and a readme."""
    folder, spark = f"{directory.rstrip('/')}/{name}", builder.images.sparkSession
    for path in [folder, *[f"{folder}_{c}" for c in classes]]:
        guard_name(spark, path)
    for c, own in classes.items():
        filters = [*common, *own]
        export(builder.query(filters, "image", label_filter_column), f"{folder}_{c}", "image", filters, f"{name}_{c}", version, copy_images=copy_images)
    write_csv(classification_table(builder, folder, common, classes, label_filter_column, keep_label_columns), f"{folder}/{name}.csv")
    listed = [*common, *[{"class": c, "filter_list": own} for c, own in classes.items()]]
    _write_text(spark, f"{folder}/readme.txt", readme(name, "image classification", listed, version))


def remove_leftovers(spark: SparkSession, folder: str, names: list[str]) -> list[str]:
    """Delete the named files and folders below ``folder``; the names that were there."""
    found = []
    for name in names:
        fs, target = _fs(spark, f"{folder.rstrip('/')}/{name}")
        if fs.exists(target):
            fs.delete(target, True)
            found.append(name)
    return found
