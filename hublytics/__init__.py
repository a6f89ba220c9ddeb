"""hublytics: a Spark-native parcel-delivery warehouse.

Raw parcel tables -> cleaned staging views -> star schema (dims + facts)
-> aggregate marts, plus data-quality checks, SCD2 history and report
queries. Every step is a plain function from DataFrames to a DataFrame, so
Catalyst sees (and optimizes) the whole lineage.
"""

from hublytics.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
