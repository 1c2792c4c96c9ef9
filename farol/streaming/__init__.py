"""The triage report on a stream of cases."""
