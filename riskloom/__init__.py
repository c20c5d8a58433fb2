"""Spark-native multi-factor risk analytics over long (trade_date, code) panels."""
