from paylens.session import work_dir


def fake(folder):
    """A session as far as work_dir looks at it."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "hdfs://host/warehouse/"}.get(key) or default

    return type("Session", (), {"conf": conf})


def test_work_dir_follows_the_cluster_setting():
    one, two = (work_dir(fake("/shared/folder/"), "x") for _ in range(2))
    assert one.startswith("/shared/folder/x-") and one != two


def test_without_the_setting_it_is_under_the_warehouse():
    assert work_dir(fake(None), "x").startswith("hdfs://host/warehouse/_work/x-")
