from txengine.sources.schema import TX_COLUMNS, TX_SCHEMA  # noqa: F401
from txengine.sources.transactions import (  # noqa: F401
    events_transactions,
    lineitem_transactions,
    load_transactions,
    read_transactions_csv,
    write_transactions_csv,
)
