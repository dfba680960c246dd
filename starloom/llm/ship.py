"""Make this package importable in Python workers that have no copy of it."""

from __future__ import annotations

import io
import os
import uuid
import zipfile

from pyspark.sql import SparkSession

from starloom.session import configure, ensure_checkpoint_dir

_SHIPPED: set[str] = set()
# Text that crosses to a Python worker at once: both sides hold a batch, beside
# each other, in memory outside the heap. Set unless the session names a size.
BATCH_BYTES = "4m"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
# Texts are long rows: a reader that decodes 4096 of them at once holds some
# 20 MB of them in a task (and as much again while its arrays grow), a writer up
# to 128 MB before it writes. A first-level map costs every partial aggregate a
# memory page more (32 MB in an executor of 3 GB). Set unless the session names
# them.
_SMALL = {"spark.sql.parquet.columnarReaderBatchSize": "256", "parquet.block.size": str(16 << 20),
          "spark.sql.codegen.aggregate.map.twolevel.enabled": "false"}


def ready(spark: SparkSession) -> SparkSession:
    """Session defaults, and once per application the package as a zip file
    in the shared folder, from where every worker loads it."""
    configure(spark)
    sc = spark.sparkContext
    if sc.getConf().get(_BATCH, None) is None:
        spark.conf.set(_BATCH, BATCH_BYTES)
    hadoop = sc._jsc.hadoopConfiguration()
    for key, value in _SMALL.items():
        if sc.getConf().get(key, None) is None and hadoop.get(key) is None:
            spark.conf.set(key, value)
    if sc.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as z:
            for folder, _, names in os.walk(os.path.join(root, "starloom")):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, root))
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/starloom-{uuid.uuid4().hex}.zip")
        out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
        out.write(held.getvalue())
        out.close()
        sc.addPyFile(path.toString())
        _SHIPPED.add(sc.applicationId)
    return spark
