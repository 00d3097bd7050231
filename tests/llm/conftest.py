import sys
from pathlib import Path

import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from hard_rows import EXTRA, prose, texts  # noqa: E402

@pytest.fixture(scope="session")
def frame() -> pd.DataFrame:
    out = pd.DataFrame(texts(), columns=["doc_id", "text", "lang", "source"])
    out["doc_id"] = out["doc_id"].astype("Int64")
    out["n_chars"] = out["text"].str.len().astype("Int64")
    return out.assign(**EXTRA)


@pytest.fixture(scope="session")
def tables(frame, tmp_path_factory):
    """Documents and pages with hard rows, in the layout of the queries."""
    path = tmp_path_factory.mktemp("tables")
    frame.to_parquet(path / "documents.parquet", row_group_size=25)
    html = [*(prose(i % 7, 50) for i in range(40)), None, "", None, "é" * 900, "x" * 200_000]
    pages = pd.DataFrame({"page_id": pd.array([*range(40, 0, -1), 90, 91, None, None, 92], dtype="Int64"),
                          "url": ["http://a/ b\r\nc", None, *[f"http://h/{i}" for i in range(43)]], "html": html})
    pages = pd.concat([pages, pages.iloc[3:5]]).assign(payload="x", digest="y", refers_to=1)
    pages.to_parquet(path / "pages.parquet", row_group_size=20)
    return str(path)


@pytest.fixture(scope="session")
def nothing(frame, tmp_path_factory):
    """The same tables without rows."""
    path = tmp_path_factory.mktemp("nothing")
    frame.astype({"text": "string", "lang": "string", "source": "string"}).iloc[:0].to_parquet(path / "documents.parquet")
    pd.DataFrame({"page_id": pd.array([], "Int64"), "url": pd.array([], "string"), "html": pd.array([], "string")}).to_parquet(
        path / "pages.parquet")
    return str(path)
