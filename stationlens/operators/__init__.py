"""DataFrame -> DataFrame operators.

series (daily last value, lags, variations), ranking (window / skew-safe range ranks,
range_shift, top-k), enrich (per-entity summaries), dims (dimensions, price fact),
reports (cheapest, regional, weekly), anomalies (price anomalies, volume/freshness
monitors), history (SCD-2 merges, as-of reads, rebuild), quality (checks and suite),
dashboard (query API), explode (list/period unpivots, date spine, calendar).
"""
