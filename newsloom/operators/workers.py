"""This package on Python workers."""

import io
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame

from newsloom.operators.checkpoints import new_place

_shipped = set()


def on_workers(df: DataFrame) -> DataFrame:
    """`df`, after this package has been made importable for Python workers."""
    spark = df.sparkSession
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).resolve().parents[1]
        content = io.BytesIO()
        with zipfile.ZipFile(content, "w") as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        path, target, files = new_place(spark, ".zip")
        out = files.create(target)
        out.write(content.getvalue())
        out.close()
        files.deleteOnExit(target)
        spark.sparkContext.addPyFile(path)
        _shipped.add(application)
    return df
