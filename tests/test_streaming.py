import pytest

from tests.conftest import rows_of
from tidemark.operators.transforms import to_src, with_row_hash
from tidemark.streaming.lander import land_stream, read_landed


def test_each_file_is_landed_once(spark, customers, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    hashed = with_row_hash(customers)

    def arrive(part, folder):
        hashed.where(f"c_custkey % 3 = {part}").write.parquet(f"{source}/{folder}")

    def land():
        land_stream(spark, source, hashed.schema, target, checkpoint, 1).awaitTermination()

    arrive(0, "2024/05/01/10")
    land()
    assert read_landed(spark, target).count() == customers.where("c_custkey % 3 = 0").count()
    arrive(1, "2024/05/01/11")
    arrive(2, "2024/05/01/12")
    land()
    land()
    assert rows_of(read_landed(spark, target)) == rows_of(to_src(customers))


def test_filled_target_refuses_a_new_checkpoint(spark, customers, tmp_path):
    """A lost checkpoint would land all files again under numbers already taken."""
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    customers.write.parquet(source)
    land_stream(spark, source, customers.schema, target, str(tmp_path / "first")).awaitTermination()
    with pytest.raises(ValueError, match="another checkpoint"):
        land_stream(spark, source, customers.schema, target, str(tmp_path / "second"))
    assert read_landed(spark, target).count() == customers.count()
