from arspark.sources.tables import Tables, load_tables  # noqa: F401
from arspark.sources.adapter import Domain  # noqa: F401
