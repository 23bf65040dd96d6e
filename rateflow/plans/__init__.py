"""Plans: feature matrix, model, evaluation, the whole job and the named queries."""
