"""Sources: driver tables, Kafka-shaped topics, stored bars."""

from tickflow.sources.tables import (  # noqa: F401
    read_table, events_ticks, lineitem_ticks, registry, price_ranges,
)
from tickflow.sources.topic import (  # noqa: F401
    read_topic, decode_ticks, split_bad, encode_ticks, decode_snapshot,
    read_bars, topic_options,
)
