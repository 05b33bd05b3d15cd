"""Word statistics over posts: seasonal words, bursts and topics, as Spark jobs."""
