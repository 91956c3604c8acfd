import pytest

from conftest import SMALL
from tallyfold.workload.queries import QUERIES
from tallyfold.workload.yardstick import YARDSTICK


@pytest.mark.parametrize("name", sorted(YARDSTICK))
def test_one_pass_equals_the_join_form(spark, name):
    one_pass, joined = (f(spark, SMALL) for f in (QUERIES[name], YARDSTICK[name]))
    assert one_pass.columns == joined.columns
    assert sorted(map(str, one_pass.collect())) == sorted(map(str, joined.collect()))
