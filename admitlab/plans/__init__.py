"""admitlab.plans."""
