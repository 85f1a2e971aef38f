import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def docs(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    return make
