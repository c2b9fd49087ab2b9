from concurrent.futures import ThreadPoolExecutor

import pytest

from ledgerlake import session
from ledgerlake.plans import model
from ledgerlake.plans.model import Model

from .conftest import SF_SMALL


class _Conf:
    def get(self, key, default=None):
        return default


class _Cluster:
    conf = _Conf()

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Cluster)


def test_layers_lie_under_the_application_and_are_written_alone(spark):
    model.forget_written()
    m = Model(spark, SF_SMALL)
    assert m.fx_rates.count() and not model._WRITTEN                 # needs no layer
    m.bronze_manifest
    assert [k[2] for k in model._WRITTEN] == ["bronze_run_manifest"]  # and no other bronze table
    assert all(spark.sparkContext.applicationId in path for path, _ in model._WRITTEN.values())


def test_two_models_on_one_input_share_the_tables(spark):
    a, b = Model(spark, SF_SMALL), Model(spark, SF_SMALL)
    first = a.silver_invoice.count()
    files = set(a.silver_invoice.inputFiles())
    assert b.silver_invoice.count() == first and set(b.silver_invoice.inputFiles()) == files


def test_concurrent_models_write_a_layer_once(spark):
    model.forget_written()
    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(lambda _: (Model(spark, SF_SMALL).silver_invoice.count(),
                                         tuple(sorted(Model(spark, SF_SMALL).silver_invoice.inputFiles()))), range(4)))
    assert len(set(found)) == 1 and found[0][0] > 0


def test_scratch_is_removed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "scratch_folder", lambda s: f"file://{tmp_path}/own")
    spark.range(3).write.parquet(f"file://{tmp_path}/own/t")
    session.remove_scratch(spark)
    assert not (tmp_path / "own").exists()
