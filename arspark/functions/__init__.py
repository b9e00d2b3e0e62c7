from arspark.functions.dates import (  # noqa: F401
    clean_date, clean_time_of_day, clean_ts, day_of_week0, days_between, hours_between,
    minutes_between, month_end, month_start, months_between_boundaries,
)
from arspark.functions.scalars import (  # noqa: F401
    age_bucket, age_bucket_sort, bad_email, bad_phone, div_or_zero, money, pct, safe_div,
)
