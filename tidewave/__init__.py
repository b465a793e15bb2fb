"""Tidewave: keyed-signal, event and corpus analytics written as Spark jobs."""
