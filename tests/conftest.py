import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from reviewtide.session import local_session

    session = local_session(cpus=8, memory="8g", app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def prepared(spark):
    """Rated reviews of the smallest data set, with class and split."""
    import reviewtide as rt
    from reviewtide.sources import tables

    reviews = rt.prepare_text(tables.reviews_labelled(spark, SMALL))
    return rt.split_by_key(rt.with_sentiment(reviews), "review_id").cache()


@pytest.fixture(scope="session")
def model(prepared):
    import reviewtide as rt

    return rt.fit_pipeline(prepared.filter("is_train"))
