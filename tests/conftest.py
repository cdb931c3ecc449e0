import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from quayside.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    # compiling takes longer than running on rows as few as these
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    return session


@pytest.fixture
def small_splits(spark):
    """Cut files into many small blocks."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    spark.conf.set("spark.sql.files.openCostInBytes", "256")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.fixture
def land(tmp_path):
    """Write files below a stamped folder: land({"a.csv": text}) gives the folder."""

    def write(files, stamp="2024_01_01_00_00_00", root="in"):
        folder = tmp_path / root / f"snapshot_date={stamp}"
        folder.mkdir(parents=True, exist_ok=True)
        for name, content in files.items():
            target = folder / name
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_bytes(content if isinstance(content, bytes) else content.encode())
        return str(folder)

    return write


def values(df, *columns, drop=("meta_source_name",)):
    """Rows as sorted tuples, of the given columns or all but the dropped ones."""
    chosen = columns or [c for c in df.columns if c not in drop]
    return sorted((tuple(r) for r in df.select(*chosen).collect()), key=repr)
