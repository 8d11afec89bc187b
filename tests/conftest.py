import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.fixture(scope="session")
def spark():
    from gridspark.session import local_session

    s = local_session("*", "gridspark-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def make_cells(spark):
    """Cells from {(sheet, "B2"): value}, one book."""
    from gridspark.operators.grid import CELLS, as_cells
    from gridspark.sources.ooxml import place

    schema = (
        "book string, sheet string, row int, col int, dtype string, v_num double, v_str string, "
        "v_ts timestamp_ntz, v_bool boolean, err string, formula string, style_id int"
    )

    def make(values, book="b"):
        rows = []
        for (sheet, ref), v in values.items():
            row, col = place(ref)
            num = float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else None
            text = v if isinstance(v, str) else None
            rows.append((book, sheet, row, col, "n" if num is not None else "s", num, text, None, None, None, None, None))
        return as_cells(spark.createDataFrame(rows, schema)).select(*CELLS)

    return make
