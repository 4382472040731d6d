"""Named analytics jobs: commerce queries, KPIs, dashboard, forecast, text profile."""
