from plotwise.operators.transit import monthly_ridership
from plotwise.sources import proxies
from plotwise.streaming.ridership import monthly_ridership_stream
from tests.conftest import SF


def test_stream_equals_batch(spark):
    s = monthly_ridership_stream(spark, SF, query_name="mr_test")
    b = monthly_ridership(proxies.od_ridership(spark, SF), since="1996-01-01")
    key = ["date", "service", "origin", "destination", "passengers"]
    assert sorted(s.select(*key).collect()) == sorted(b.select(*key).collect())
