"""The columns of each query's result. They give both engines the same types to compare."""

RESULTS: dict[str, str] = {
    "scan_notices": (
        "resource_id bigint, title string, ca string, info string, procedure string, status string, "
        "pdf_url string, cycle string, published string, deadline string, value double, bid bigint"
    ),
    "scan_notices_with_text": (
        "resource_id bigint, title string, bid bigint, pdf_text string, detected_codes string, "
        "codes_count bigint"
    ),
    "scan_notices_text_only": "resource_id bigint, title string, pdf_text string, codes_count bigint",
    "extract_listing_rows": (
        "page_no bigint, row_no bigint, title string, resource_id string, ca string, info string, "
        "published string, deadline string, procedure string, status string, pdf_url string, "
        "awarddate string, value string, cycle string"
    ),
    "extract_listing_rows_v2": (
        "page_no bigint, row_no bigint, title string, resource_id string, ca string, info string, "
        "published string, deadline string, procedure string, status string, pdf_url string, "
        "awarddate string, value string, cycle string"
    ),
    "page_window": "page_no bigint, page_id bigint, url string",
    "page_window_offset": "page_no bigint, page_id bigint, url string",
    "backfill_chunks": "chunk_id bigint, start_page bigint, max_pages bigint, n_rows bigint",
    "union_pages": (
        "page_no bigint, row_no bigint, title string, resource_id string, ca string, info string, "
        "published string, deadline string, procedure string, status string, pdf_url string, "
        "awarddate string, value string, cycle string"
    ),
    "ingest_messages": "resource_id bigint, title string, ca string, status string, bid bigint",
    "quarantine": "reason string, attempt bigint, n bigint",
    "retry_quarantine": "fate string, n bigint",
    "normalize_union_messages": (
        "resource_id bigint, title string, should_bid boolean, confidence double, reasoning string, "
        "codes_count_score double, total_score double, pdf_content string, priority string, timestamp string"
    ),
    "json_defaults": (
        "resource_id bigint, reasoning string, codes_count_score double, has_codes_score double, "
        "title_length_score double, ca_score double, text_features_score double, total_score double"
    ),
    "upsert_notices": (
        "resource_id bigint, title string, ca string, info string, procedure string, status string, "
        "pdf_url string, cycle string, published string, deadline string, value double, bid bigint, "
        "ml_status string, ml_processed boolean"
    ),
    "upsert_notices_twice": (
        "resource_id bigint, title string, ca string, info string, procedure string, status string, "
        "pdf_url string, cycle string, published string, deadline string, value double, bid bigint, "
        "ml_status string, ml_processed boolean"
    ),
    "upsert_doc_content": (
        "resource_id bigint, pdf_text string, extraction_timestamp string, processing_status string, "
        "detected_codes string, codes_count bigint"
    ),
    "upsert_summaries": "resource_id bigint, ai_summary string, created_at string, updated_at string",
    "update_predictions": (
        "resource_id bigint, title string, ml_bid boolean, ml_confidence double, ml_reasoning string, "
        "ml_status string, ml_processed boolean, updated_at string"
    ),
    "unmatched_updates": "resource_id bigint",
    "update_status": "resource_id bigint, title string, ml_processed boolean, ml_status string",
    "mark_notified": "resource_id bigint, notification_sent boolean, notification_sent_at string",
    "apply_labels": "resource_id bigint, bid bigint",
    "apply_labels_repeated": "resource_id bigint, bid bigint",
    "update_predictions_repeated": "resource_id bigint, ml_bid boolean, ml_reasoning string, ml_status string",
    "ingest_raw": "resource_id bigint, title string",
    "route_by_url": "route string, n bigint",
    "align_schema": (
        "resource_id bigint, title string, ca string, info string, published string, deadline string, "
        "procedure string, status string, pdf_url string, awarddate string, value double, cycle string, "
        "bid bigint, notification_sent boolean, notification_sent_at string, created_at string, "
        "updated_at string, ml_processed boolean, ml_bid boolean, ml_confidence double, ml_reasoning string, "
        "ml_status string"
    ),
    "search_notices": (
        "resource_id bigint, title string, ca string, published string, deadline string, status string, "
        "value double, pdf_url string"
    ),
    "search_notices_resource": (
        "resource_id bigint, title string, ca string, published string, deadline string, status string, "
        "value double, pdf_url string"
    ),
    "filter_notices": (
        "resource_id bigint, title string, ca string, published string, deadline string, status string, "
        "value double"
    ),
    "filter_min_value": "resource_id string, value string",
    "find_opportunities": (
        "resource_id bigint, title string, ca string, published string, deadline string, status string, "
        "value double, pdf_url string, days_remaining bigint"
    ),
    "find_opportunities_text": (
        "resource_id bigint, title string, ca string, published string, deadline string, status string, "
        "value double, pdf_url string, days_remaining bigint"
    ),
    "clean_frame": "resource_id bigint, title string, ca string, procedure string, pdf_url string, bid bigint",
    "clean_frame_with_text": (
        "resource_id bigint, title string, ca string, procedure string, pdf_url string, bid bigint, "
        "pdf_text string, detected_codes string, codes_count bigint, published string, deadline string, "
        "status string, value double"
    ),
    "modeling_dataset": (
        "resource_id bigint, title string, bid bigint, codes_count bigint, title_length bigint, "
        "title_word_count bigint, pdf_text_length bigint, pdf_text_word_count bigint, "
        "pdf_to_title_ratio double, code_density double, has_pdf bigint, has_pdf_content bigint, "
        "has_codes bigint"
    ),
    "has_text_filter": "resource_id bigint",
    "drop_columns": (
        "resource_id bigint, title string, ca string, status string, procedure string, pdf_url string, "
        "bid bigint"
    ),
    "recent_activity": (
        "resource_id bigint, text_length bigint, processing_status string, extraction_timestamp string"
    ),
    "notices_of_day": (
        "resource_id bigint, title string, ca string, published string, deadline string, status string, "
        "value double"
    ),
    "recent_notices": (
        "resource_id bigint, title string, ca string, published string, deadline string, status string, "
        "value double"
    ),
    "notified_notices": "resource_id bigint, title string, notification_sent_at string",
    "sample_rows": "resource_id bigint, title string",
    "score_guard": "resource_id bigint, is_scored boolean, problem string, confidence double",
    "distinct_values": "procedure string",
    "next_unlabelled": "resource_id bigint, title string, ca string, info string",
    "get_notice": (
        "resource_id bigint, title string, ca string, published string, deadline string, status string, "
        "value double, info string, procedure string, pdf_url string, bid bigint"
    ),
    "get_record": "resource_id bigint, title string, contracting_authority string, status string",
    "get_doc_content": "resource_id bigint, pdf_text string, detected_codes string, codes_count bigint",
    "join_left_text": "resource_id bigint, title string, pdf_text string, processing_status string",
    "join_failures": (
        "resource_id bigint, title string, ca string, pdf_url string, processing_status string, "
        "extraction_timestamp string, pdf_text string"
    ),
    "pending_documents": (
        "resource_id bigint, title string, ca string, pdf_url string, published string, deadline string"
    ),
    "filter_new_records": "resource_id bigint, title string",
    "pending_count": "pending bigint",
    "enrich_messages": (
        "resource_id bigint, title string, summary_type string, text_source string, pdf_text string, "
        "codes_count bigint, problem string"
    ),
    "count_by_label": "bid bigint, n bigint",
    "doc_status_summary": (
        "total_records bigint, completed_records bigint, latest_extraction string, processed_last_hour bigint"
    ),
    "url_availability": "total bigint, with_url bigint, without_url bigint, availability_pct double",
    "migration_audit": (
        "total_records bigint, published_dates bigint, deadline_dates bigint, award_dates bigint, "
        "valid_values bigint, labelled_records bigint, ml_processed_count bigint, ml_predicted_count bigint, "
        "avg_value double, max_value double, positive_labels bigint, negative_labels bigint, "
        "ml_positive_predictions bigint, ml_negative_predictions bigint, ml_processed_records bigint, "
        "bid_status_count bigint, no_bid_status_count bigint, pending_status_count bigint"
    ),
    "notification_totals": "total bigint, notified bigint, pending bigint",
    "notice_statistics": "total bigint, open bigint, closed bigint, recent bigint",
    "top_authorities": "ca string, n bigint",
    "status_counts": "status string, n bigint",
    "doc_status_rows": (
        "resource_id bigint, title string, ca string, published string, deadline string, doc_status string, "
        "extraction_timestamp string, text_length bigint"
    ),
    "status_funnel": "status string, n bigint, percentage double",
    "hourly_activity": "hour string, processed bigint, successful bigint, failed bigint",
    "hourly_activity_day": "hour string, processed bigint, successful bigint, failed bigint",
    "authority_rate": "ca string, total bigint, with_url bigint, processed bigint, rate_pct double",
    "load_checkpoint": (
        "checkpoint string, total_records bigint, latest_published string, records_with_url bigint, "
        "pending_documents bigint"
    ),
    "daily_counts": "day string, n bigint, n_keys bigint",
    "flag_counts": "flag boolean, n bigint",
    "prediction_stats": "total bigint, predicted bigint, avg_probability double",
    "duplicate_keys": "l_orderkey bigint, n bigint",
    "available_codes": "code string",
    "code_statistics": "code string, n bigint, percentage double",
    "frequency_bands": "band string, n_codes bigint",
    "code_frequency_bands": "band string, n_codes bigint",
    "code_sparsity": "n_rows bigint, n_set bigint, avg_codes double, n_codes bigint, density double, sparsity double",
    "code_correlation": "a string, b string, corr double",
    "describe_columns": (
        "column string, n bigint, mean double, std double, min double, max double, q25 double, q50 double, "
        "q75 double"
    ),
    "describe_text": (
        "column string, n bigint, mean double, std double, min double, max double, q25 double, q50 double, "
        "q75 double"
    ),
    "length_buckets": "bucket string, n bigint, share double",
    "quality_profile": (
        "column string, nulls bigint, infinities bigint, zeros bigint, null_share double, zero_share double, "
        "mostly_zero boolean"
    ),
    "high_correlations": "a string, b string, corr double",
    "feature_label_corr": "feature string, corr double",
    "correlations_with_gaps": "a string, b string, corr double",
    "crosstab_margins": "has_codes string, bid string, n bigint",
    "bid_rate_by_flag": "rate_with double, rate_without double, difference double",
    "bid_rate_by_codes": "codes_count bigint, n bigint, rate double",
    "class_balance": (
        "negatives bigint, positives bigint, positive_share double, negative_share double, "
        "imbalance_ratio double, severity string"
    ),
    "text_profile": (
        "min_length bigint, max_length bigint, mean_length double, with_phrase bigint, median_length double"
    ),
    "dataset_funnel": (
        "all_rows bigint, labelled bigint, with_text bigint, modelling bigint, text_share double, "
        "modelling_share double"
    ),
    "ingest_counters": "processed bigint, filtered bigint, saved bigint, queued bigint",
    "value_counts": "codes_count bigint, n bigint",
    "topk_terms": "lang string, term string, n bigint, rank bigint",
    "top_codes": "code string, n bigint",
    "confusion_matrix": "tp bigint, fp bigint, fn bigint, tn bigint",
    "classification_report": "name string, precision double, recall double, f1 double, support bigint",
    "threshold_sweep": (
        "threshold double, tp bigint, fp bigint, fn bigint, tn bigint, predicted_positive bigint, "
        "predicted_negative bigint"
    ),
    "cost_sweep": (
        "threshold double, tp bigint, fp bigint, fn bigint, tn bigint, predicted_positive bigint, "
        "predicted_negative bigint, fn_cost bigint, fp_cost bigint, total_cost bigint, recall double, "
        "precision double, miss_rate double"
    ),
    "cost_ratio_argmin": "ratio bigint, threshold double, fn bigint, fp bigint, cost bigint",
    "balanced_threshold": "threshold double, fn bigint, fp bigint, gap bigint",
    "pr_curve": "threshold double, pos bigint, neg bigint, tp bigint, fp bigint, precision double, recall double",
    "threshold_for_recall": "target double, threshold double",
    "threshold_sweep_desc": "threshold double",
    "constrained_threshold": "threshold double, recall double, total_cost bigint, fn bigint, fp bigint",
    "f1_threshold": "threshold double, precision double, recall double, f1 double",
    "average_precision": "average_precision double, pr_area double",
    "roc_curve": "threshold double, pos bigint, neg bigint, tp bigint, fp bigint, tpr double, fpr double",
    "roc_auc": "auc double",
    "score_histogram": "y bigint, bin bigint, n bigint, density double",
    "score_histogram_zoom": "y bigint, bin bigint, n bigint, density double",
    "metrics_at_thresholds": "threshold double, tp bigint, fp bigint, precision double, recall double",
    "error_cost": "fn bigint, fp bigint, fn_cost bigint, fp_cost bigint, total_cost bigint, missed_share double",
    "threshold_delta": (
        "current_threshold double, chosen_threshold double, fn_change bigint, fp_change bigint, "
        "cost_change bigint"
    ),
    "strip_html": "page_id bigint, stripped string",
    "parse_datetime": "resource_id string, published string, deadline string",
    "parse_date": "resource_id bigint, d string",
    "parse_money": "resource_id string, value double",
    "type_records": (
        "resource_id bigint, title string, ca string, info string, published string, deadline string, "
        "procedure string, status string, pdf_url string, awarddate string, value double, cycle string, "
        "bid bigint"
    ),
    "build_url": "resource_id string, url string, url_v2 string",
    "migrate_dates": "resource_id bigint, published string, deadline_day string",
    "migrate_money": "resource_id string, value double",
    "migrate_label": "resource_id bigint, bid bigint",
    "rollback_types": "resource_id bigint, published string, deadline string, value string",
    "text_features": (
        "resource_id bigint, title_length bigint, title_word_count bigint, pdf_text_length bigint, "
        "pdf_text_word_count bigint"
    ),
    "text_ratios": "resource_id bigint, pdf_to_title_ratio double, code_density double",
    "presence_flags": "resource_id bigint, has_pdf bigint, has_pdf_content bigint, has_codes bigint",
    "contains_year": "resource_id bigint, contains_year bigint",
    "combined_text": "resource_id bigint, combined string",
    "section_extract": "doc_id bigint, section string",
    "truncate_text": "doc_id bigint, cut string",
    "load_code_dictionary": "code string, code_pos bigint",
    "detect_codes": "resource_id bigint, detected_codes string, codes_count bigint",
    "detect_codes_joined": "resource_id bigint, detected_codes string, codes_count bigint",
    "encode_authority": "resource_id bigint, ca string, ca_encoded double",
    "term_counts": (
        "resource_id bigint, n_words bigint, count_the bigint, count_and bigint, count_that bigint, "
        "count_for bigint, count_was bigint, count_with bigint, count_this bigint, count_are bigint, "
        "count_from bigint, count_than bigint"
    ),
    "term_scores": (
        "resource_id bigint, tfidf_the double, tfidf_and double, tfidf_that double, tfidf_for double, "
        "tfidf_was double, tfidf_with double, tfidf_this double, tfidf_are double, tfidf_from double, "
        "tfidf_than double"
    ),
    "exclusion_score": "resource_id bigint, exclusion_score double",
    "feature_vector": (
        "resource_id bigint, codes_count double, has_codes double, title_length double, ca_encoded double, "
        "exclusion_score double, tfidf_the double, tfidf_and double, tfidf_that double, tfidf_for double, "
        "tfidf_was double, tfidf_with double, tfidf_this double, tfidf_are double, tfidf_from double, "
        "tfidf_than double"
    ),
    "normalize_features": (
        "resource_id bigint, codes_count double, has_codes double, title_length double, ca_encoded double, "
        "exclusion_score double, tfidf_the double, tfidf_and double, tfidf_that double, tfidf_for double, "
        "tfidf_was double, tfidf_with double, tfidf_this double, tfidf_are double, tfidf_from double, "
        "tfidf_than double"
    ),
    "linear_score": "resource_id bigint, score double",
    "predict_rule": (
        "resource_id bigint, title string, decision string, exclusion_score double, ml_bid boolean, "
        "ml_confidence double, ml_status string, ml_reasoning string"
    ),
    "reason_text": "resource_id bigint, ml_reasoning string",
    "component_scores": (
        "resource_id bigint, codes_count_score double, has_codes_score double, title_length_score double, "
        "ca_score double, text_features_score double, total_score double"
    ),
    "route_by_length": "resource_id bigint, stage string, strict_stage string",
    "review_category": (
        "resource_id bigint, category string, action string, priority string, message string, "
        "ml_probability double, requires_summary boolean"
    ),
    "category_volumes": "category string, n bigint, share double",
    "signed_confidence": "resource_id bigint, confidence double",
    "message_priority": "resource_id bigint, priority string",
    "scored_message": (
        "resource_id bigint, tender_title string, should_bid boolean, confidence double, text_bytes bigint, "
        "priority string"
    ),
    "summary_type": "resource_id bigint, summary_type string",
    "title_only_message": "resource_id bigint, body string",
    "prompt_table": "resource_id bigint, prompt_md5 string",
    "extract_json": "reply_id bigint, kind bigint, found string",
    "normalize_reply": (
        "reply_id bigint, ai_summary string, key_points string, recommendation string, "
        "confidence_assessment string, processing_notes string"
    ),
    "recommend_from_text": "doc_id bigint, recommendation string",
    "processing_notes": "reply_id bigint, notes string",
    "should_notify": "reply_id bigint, notify boolean, note string, strict_notify boolean",
    "notify_priority": "reply_id bigint, priority string, action string",
    "notify_payload": (
        "resource_id string, reply_id bigint, title string, priority string, summary string, "
        "authority string, estimated_value string, is_override boolean, reasoning string, n_notes bigint"
    ),
    "digest_rows": (
        "subject string, resource_id string, title string, contracting_authority string, summary string, "
        "priority string, prediction_confidence double, deadline string, estimated_value string, "
        "timestamp string, portal_link string, ai_summary string, key_points string, recommendation string, "
        "confidence_assessment string, pdf_url string, ml_reasoning string"
    ),
    "digest_text": "digest_md5 string, resource_id string",
    "priority_class": "reply_id bigint, priority string",
    "valid_recipients": "c_custkey bigint, recipients string",
    "notification_fanout": "reply_id bigint, priority string, recipient string",
    "code_onehot": "resource_id bigint, bits string",
    "label_encode": "resource_id bigint, ca_encoded bigint",
    "scale_features": "l_orderkey bigint, l_linenumber bigint, l_quantity double, l_discount double",
    "tfidf_terms": "term string, tf bigint, df bigint, idf double",
    "tfidf_fixed_vocab": (
        "doc_id bigint, tfidf_the double, tfidf_and double, tfidf_that double, tfidf_for double, "
        "tfidf_was double, tfidf_with double, tfidf_this double, tfidf_are double, tfidf_from double, "
        "tfidf_than double"
    ),
    "tokenize": "doc_id bigint, n bigint, words_md5 string",
    "class_weights": "resource_id bigint, bid bigint, weight double",
    "feature_matrix": (
        "resource_id bigint, bid bigint, codes_count double, has_codes double, title_length double, "
        "text_length double, ca_encoded double, tfidf_the double, tfidf_and double, tfidf_that double, "
        "tfidf_for double, tfidf_was double, tfidf_with double, tfidf_this double, tfidf_are double, "
        "tfidf_from double, tfidf_than double"
    ),
    "rare_to_null": "event_id bigint, user_id bigint",
    "stratified_folds": "bid bigint, fold bigint, n bigint",
    "stratified_split": "bid bigint, is_test boolean, n bigint",
    "count_vectors": "resource_id bigint, n_terms double",
    "screen_notices": (
        "resource_id bigint, processing_stage string, decision string, ml_status string, "
        "ml_confidence double, ml_reasoning string, category string"
    ),
    "redrive_quarantine": "sink string, status string, n bigint",
    "stream_chain": "sink string, status string, n bigint",
    "stream_hourly": "hour string, processed bigint, successful bigint, failed bigint",
    "stream_dedupe": "event_id bigint, event_type string, value double",
    "stream_available_now": "resource_id bigint, title string",
}
