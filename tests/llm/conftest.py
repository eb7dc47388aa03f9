import pytest


@pytest.fixture(scope="session")
def write(spark, tmp_path_factory):
    """write(documents=[...rows], ...) -> the folder of small tables, as the driver lays them out."""
    kinds = {
        "documents": "doc_id long, text string, lang string, source string, n_chars long",
        "benchmark": "item_id long, text string",
        "labels": "doc_id long, quality int, toxic int",
        "conversations": "conv_id long, turn long, role string, text string",
        "pages": "page_id long, url string, html string",
    }

    def put(**tables):
        top = tmp_path_factory.mktemp("sf")
        for name, rows in tables.items():
            if name == "documents":
                rows = [(i, t, "en", "src0", len(t or "")) for i, t in rows]
            spark.createDataFrame(rows, kinds[name]).write.parquet(f"{top}/{name}.parquet")
        return str(top)

    return put
