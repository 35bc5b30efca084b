"""Mobility analytics on Spark: GPS pings to stops, visits, places and activity hours."""
