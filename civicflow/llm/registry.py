"""What ``__spark_entry__`` adds: queries and their SQL."""

from civicflow.llm.oracles import oracle_sql  # noqa: F401
from civicflow.llm.queries import queries  # noqa: F401
