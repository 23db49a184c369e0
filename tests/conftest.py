import json
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
sys.path.insert(0, str(Path(__file__).parent))

from dockmetrics import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions=4,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def land(tmp_path):
    """Write JSON lines to a landing file; later files get later times."""
    count = iter(range(1, 1_000))

    def write(topic, records, root=tmp_path / "landing"):
        folder = Path(root) / topic
        folder.mkdir(parents=True, exist_ok=True)
        number = next(count)
        path = folder / f"{number:04d}.json"
        lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))
        return str(folder)

    return write


@pytest.fixture(scope="session")
def rows_of():
    def rows(df, *columns):
        frame = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in frame.collect()), key=str)

    return rows
