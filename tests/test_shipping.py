"""Functions sent to Python workers must not need the package there."""

import subprocess
import sys
import textwrap

from conftest import DATA, ROOT


def test_workers_do_not_import_the_package(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(
        textwrap.dedent(
            f"""
            import sys
            sys.path.insert(0, {str(ROOT)!r})
            from pyspark.sql import functions as F
            from terrella.session import local_session
            from terrella.operators import knn
            from terrella import catalog
            spark = local_session(2, 2)
            queries = catalog.queries()
            for name in ("udf_map_partitions", "udf_scalar_reduce", "knn_exact"):
                assert queries[name](spark, {DATA!r}).count() > 0
            table = spark.read.parquet({DATA + "/embeddings.parquet"!r})
            assert knn.k_nearest(table, table, 2, query_bytes=0).count() == 2 * table.count()
            """
        )
    )
    subprocess.run([sys.executable, str(script)], cwd=tmp_path, check=True, timeout=240, capture_output=True)
