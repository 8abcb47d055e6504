import pytest

from voltrail.llm import store


def test_a_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        store.shared_dir(Session())
