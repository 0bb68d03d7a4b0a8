"""Layer plans composed from the operators, and the jobs that publish them."""
