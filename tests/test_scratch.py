"""Scratch files must be gone once the application has ended."""

import subprocess
import sys
import textwrap

from conftest import DATA, ROOT


def test_scratch_is_removed_at_the_end(tmp_path):
    shared = tmp_path / "shared"
    shared.mkdir()
    script = tmp_path / "run.py"
    script.write_text(
        textwrap.dedent(
            f"""
            import sys
            sys.path.insert(0, {str(ROOT)!r})
            from terrella import catalog
            from terrella.session import local_session
            spark = local_session(2, 2, **{{"spark.checkpoint.dir": {str(shared)!r}}})
            assert catalog.queries()["scan_csv_typed"](spark, {DATA!r}).count() > 0
            spark.stop()
            """
        )
    )
    subprocess.run([sys.executable, str(script)], cwd=tmp_path, check=True, timeout=240, capture_output=True)
    assert not list(shared.rglob("part-*"))
