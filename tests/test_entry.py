import subprocess
import sys

from .conftest import ROOT


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_the_rest_imports_without_the_llm_folder(tmp_path):
    code = "import sys; sys.modules['factlake.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert e.queries() and not any(q.startswith('op') for q in e.queries())"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=False).returncode == 0
