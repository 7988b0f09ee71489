"""churnflow: the data work of a tabular classification model's life, as Spark jobs."""

from churnflow.spec import DatasetSpec, telecom_spec

__all__ = ["DatasetSpec", "telecom_spec"]
