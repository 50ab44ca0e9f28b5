"""Finance, settlement and KPI reports: functions of named DataFrames."""
