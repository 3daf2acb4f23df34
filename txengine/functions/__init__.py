from txengine.functions.columns import (  # noqa: F401
    amount_total,
    day_number,
    exact_part,
    night_flag,
    rest_part,
    round_half_away,
    total,
    weekend_flag,
)
