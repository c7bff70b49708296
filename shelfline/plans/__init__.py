"""Plan shapes shared by the operators: per-key latest, bounded ordinals, session tuning."""
